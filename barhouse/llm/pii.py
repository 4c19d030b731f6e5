"""Personal data: fixed patterns, extended by a skip-chain conditional random field."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: The field is fitted on the candidate tokens of about this many documents, chosen by a hash of the id.
FIT_DOCUMENTS = 20_000
#: And on this many tokens at most.
FIT_TOKENS = 200_000
#: Log potential of equal labels of an email and a distant token that equals its local part. Not fitted: such
#: tokens have no labels to learn from, and nothing else is known of them.
LOCAL_PRIOR = 5.0
#: A free token becomes part of a span at this probability.
CERTAIN = 0.95
ROUNDS = 12
#: Log potential, before fitting, of equal labels of linked distant tokens.
SKIP_PRIOR = 2.0
FEATURES = 1 << 12
#: Tokens that no pattern covers, and those that a refused match only shares; the latter train nothing.
FREE, UNSURE = -1, -2
SEED = 17

# The patterns of the contract. A run of digits is entered at its start only, and the text before an
# @ is read backwards from it: the same matches in time linear in the text.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
#: Local parts that are looked for elsewhere: with a letter, and no plain word ("info").
_NAME = re.compile(r"(?=.*[a-z])(?=.*[0-9._%+-]).{4,}")
_EDGE = re.compile(r"^[^\w+@]+|[^\w]+$")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        d *= 1 + k % 2
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(kind number, start, end) of all that the patterns accept, by kind and start; and what they refuse."""
    found: list[tuple[int, int, int]] = []
    refused: list[tuple[int, int]] = []
    if "@" in text:
        found += [(0, a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found, refused
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1:
                good = all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m[0].split(".")))
            elif kind == 2:
                good = 13 <= len(digits) <= 19 and luhn(digits)
            else:
                good = 9 <= len(digits) <= 15
            if good:
                found.append((kind, m.start(), m.end()))
            elif kind != 2 or len(digits) >= 13:  # a number that is too short for a card may be of another kind
                refused.append((m.start(), m.end()))
    return found, refused


# Nodes of the field: tokens with a digit, an @ or a leading +, and those that equal the local part of an
# email of the text. All other tokens are surely "none" and end a chain.


def _shape(token: str) -> str:
    return "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in token)


def _squeezed(shape: str) -> str:
    return re.sub(r"(.)\1+", r"\1+", shape)


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


def _local(email: str) -> str:
    return email.split("@")[0].lower().strip("._%+-")


def _same(token: str, locals_: set[str]) -> list[str]:
    """What two distant tokens must share to be linked: the whole, or its digits' tail, or its local part."""
    core = _EDGE.sub("", token).lower()
    digits = re.sub("[^0-9]", "", core)
    out = [f"w:{core}"] if len(core) > 3 else []
    if len(digits) >= 7:
        out.append(f"d:{digits[-7:]}")
    if "@" in core:
        out.append(f"l:{_local(core)}")
    elif core in locals_:
        out.append(f"l:{core}")
    return out


@dataclass
class Nodes:
    """The candidate tokens of one text, the links between them, and what is known of their labels."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    known: list[int]  # a label, FREE or UNSURE
    local: list[tuple[int, int]] = field(default_factory=list)  # links to and from local parts without their @


def nodes_of(text: str, base: list[tuple[int, int, int]], refused: list[tuple[int, int]]) -> Nodes:
    out = Nodes([], [], [], [], [])
    marks = sorted([(a, b, k + 1) for k, a, b in base] + [(a, b, 0) for a, b in refused], key=lambda m: (m[0], -m[2]))
    tokens = list(_TOKEN.finditer(text))
    locals_ = {x for x in (_local(text[a:b]) for k, a, b in base if k == 0) if _NAME.fullmatch(x)}
    last: dict[str, tuple[int, bool]] = {}
    before = -2
    for k, m in enumerate(tokens):
        token = m[0]
        if not ("@" in token or token[0] == "+" or _DIGIT.search(token)):
            if not locals_ or _EDGE.sub("", token).lower() not in locals_:
                continue
        node = len(out.spans)
        a, b = m.span()
        core = _EDGE.sub("", token)
        if core:
            a += token.index(core)
            b = a + len(core)
        out.spans.append((a, b))
        shape = _shape(core)
        left = tokens[k - 1][0] if k else ""
        right = tokens[k + 1][0] if k + 1 < len(tokens) else ""
        names = [
            "bias",
            f"shape {shape[:40]}",
            f"squeezed {_squeezed(shape)}",
            f"luhn {13 <= len(re.sub('[^0-9]', '', core)) <= 19 and luhn(re.sub('[^0-9]', '', core))}",
            f"digits {min(20, sum(c.isdigit() for c in core))}",
            f"letters {min(3, sum(c.isalpha() for c in core))}",
            f"marks {''.join(sorted(set(re.sub('[a9]', '', shape))))}",
            f"left {_squeezed(_shape(left))[:12]}",
            f"right {_squeezed(_shape(right))[:12]}",
        ]
        bare = core.lower() in locals_
        out.features.append([_bucket(n) for n in (["local part"] if bare else names)])
        if before == k - 1 and node:
            out.chain.append((node - 1, node))
        before = k
        for name in _same(token, locals_):
            if name in last:
                other, of_bare = last[name]
                (out.local if bare or of_bare else out.skip).append((other, node))
            last[name] = node, bare
        over = [(s, e, kind) for s, e, kind in marks if s < b and a < e]
        label = next((kind for _, _, kind in over if kind), None)
        if label is None:  # refused as a whole, refused together with other tokens, or not looked at
            label = 0 if any(a <= s and e <= b for s, e, _ in over) else UNSURE if over else FREE
        out.known.append(label)
    return out


# The field: log potentials per token, for neighbours, and for linked distant tokens.


@dataclass
class Field:
    unary: np.ndarray  # FEATURES x labels
    chain: np.ndarray  # labels x labels
    skip: np.ndarray

    def labels(self, nodes: Nodes) -> np.ndarray:
        """Marginal probabilities by loopy belief propagation; known labels are fixed."""
        own = np.array([self.unary[f].sum(axis=0) for f in nodes.features])
        known = np.array(nodes.known)
        fixed = known >= 0
        own[fixed] = -50.0
        own[fixed, known[fixed]] = 0.0
        links = [(a, b, self.chain) for a, b in nodes.chain] + [(a, b, self.skip) for a, b in nodes.skip]
        links += [(a, b, LOCAL_PRIOR * np.eye(len(LABELS))) for a, b in nodes.local]
        if not links:
            return _softmax(own)
        source = np.array([x for a, b, _ in links for x in (a, b)])
        target = np.array([x for a, b, _ in links for x in (b, a)])
        pair = np.array([p for _, _, table in links for p in (table, table.T)])
        back = np.arange(len(source)) ^ 1
        message = np.zeros((len(source), len(LABELS)))
        for _ in range(ROUNDS):
            belief = own.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[back])[:, :, None] + pair
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            message = 0.5 * message + 0.5 * new
        belief = own.copy()
        np.add.at(belief, target, message)
        return _softmax(belief)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_field(rows: list[tuple[list[int], int, list[int], list[int], list[int]]], steps: int = 300) -> Field:
    """Pseudo-likelihood by gradient ascent. A row: features, label, labels left, right and linked.

    Tokens that no pattern covers count as "none".
    """
    n, size = len(rows), len(LABELS)
    fitted = Field(np.zeros((FEATURES, size)), np.zeros((size, size)), SKIP_PRIOR * np.eye(size))
    if not n:
        fitted.unary[_bucket("bias"), 0] = 10.0
        return fitted
    where = np.concatenate([np.full(len(r[0]), i) for i, r in enumerate(rows)])
    what = np.concatenate([np.array(r[0]) for r in rows])
    truth = np.array([r[1] for r in rows])
    counts = np.zeros((3, n, size))  # neighbours by label: left, right, linked
    for i, r in enumerate(rows):
        for k in range(3):
            np.add.at(counts[k, i], r[2 + k], 1)
    goal = np.eye(size)[truth]
    rate, prior = 0.5, fitted.skip.copy()
    for _ in range(steps):
        score = np.zeros((n, size))
        np.add.at(score, where, fitted.unary[what])
        score += counts[0] @ fitted.chain + counts[1] @ fitted.chain.T + counts[2] @ fitted.skip
        off = (goal - _softmax(score)) / n
        step = np.zeros_like(fitted.unary)
        np.add.at(step, what, off[where])
        fitted.unary += rate * (n ** 0.5 * step - 1e-4 * fitted.unary)
        fitted.chain += rate * (n ** 0.5 * (counts[0].T @ off + (counts[1].T @ off).T) - 1e-4 * fitted.chain)
        link = counts[2].T @ off
        fitted.skip += rate * (n ** 0.5 * (link + link.T) / 2 - 1e-4 * (fitted.skip - prior))
    return fitted


def _trained(nodes: Nodes) -> list[int]:
    """Labels to learn from: free tokens count as "none", but not where a known one is linked or beside that."""
    label = list(nodes.known)
    for links in (nodes.skip, nodes.local, nodes.chain):
        for a, b in links:
            for one, other in ((a, b), (b, a)):
                if label[one] == FREE and (label[other] == UNSURE or links is not nodes.chain and label[other] > 0):
                    label[one] = UNSURE
    return [0 if k == FREE else k for k in label]


def _training_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for batch in batches:
        for value in batch.column(0):
            text = value.as_py()
            base, refused = base_spans(text)
            nodes = nodes_of(text, base, refused)
            label = _trained(nodes)
            near: list[tuple[list[int], list[int], list[int]]] = [([], [], []) for _ in label]
            links = [(a, b, 0, 1) for a, b in nodes.chain] + [(a, b, 2, 2) for a, b in nodes.skip]
            for a, b, of_b, of_a in links:
                if label[a] >= 0 and label[b] >= 0:
                    near[b][of_b].append(label[a])
                    near[a][of_a].append(label[b])
            out += [(f, y, *x) for f, y, x in zip(nodes.features, label, near) if y >= 0]
    lists = pa.list_(pa.int64())
    schema = pa.schema([("f", lists), ("y", pa.int64()), ("l", lists), ("r", lists), ("s", lists)])
    columns = zip(*out) if out else [[]] * 5
    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def _candidates() -> Column:
    return F.col("text").rlike("[0-9@]")


def fit(docs: DataFrame, documents: int = FIT_DOCUMENTS) -> Field:
    """Fit the field with the patterns' spans as labels, on a sample bounded by documents and tokens."""
    texts = docs.select("doc_id", "text").where(_candidates())
    count = texts.count()
    if not count:
        return fit_field([])
    share = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < int(min(1.0, documents / count) * (1 << 30))
    rows = (
        texts.where(share)
        .select("text")
        .mapInArrow(_training_rows, "f array<long>, y long, l array<long>, r array<long>, s array<long>")
        .orderBy(F.xxhash64("f", "y", "l", "r", "s"))
        .limit(FIT_TOKENS)
        .collect()
    )
    # In a fixed order, so that a rerun gives the same sums.
    return fit_field(sorted((list(r.f), r.y, list(r.l), list(r.r), list(r.s)) for r in rows))


def added_spans(text: str, base: list[tuple[int, int, int]], refused: list[tuple[int, int]], field: Field):
    """(kind number, start, end) of free tokens that the field is certain of; neighbours of one kind join."""
    nodes = nodes_of(text, base, refused)
    if all(k >= 0 for k in nodes.known):
        return []
    chance = field.labels(nodes)
    label = chance.argmax(axis=1)
    sure = (label > 0) & (chance.max(axis=1) >= CERTAIN) & (np.array(nodes.known) < 0)
    linked = {b for _, b in nodes.chain}
    out: list[tuple[int, int, int]] = []
    previous = -2
    for i in np.flatnonzero(sure).tolist():
        a, b = nodes.spans[i]
        kind = int(label[i]) - 1
        if previous == i - 1 and i in linked and out[-1][0] == kind:
            out[-1] = (kind, out[-1][1], b)
        else:
            out.append((kind, a, b))
        previous = i
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


_RESULT = pa.schema(
    [("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base", pa.string()), ("spans", pa.string())]
)


def _find(field: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                base, refused = base_spans(text)
                more = added_spans(text, base, refused, field)
                counts = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
                rows.append((*counts, _joined(base), _joined(base + more)))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_RESULT)[1:])] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=_RESULT)

    return run


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans): one row per row of ``docs``.

    ``base`` lists what the fixed patterns find in the whole text, ``spans`` that
    and what the field adds, as kind:start:end in code points. The field's nodes
    are the tokens with a digit, an @ or a leading +, and those that equal the local
    part of one of the text's emails; neighbours share potentials, and so do distant tokens that are equal, end in the same seven digits, or have
    the same local part (each with its previous occurrence, so links grow with the
    text). What a pattern accepts or refuses is evidence; the rest is free. Loopy
    message passing carries labels along the links, so a number that is known in
    one place of a document is found in others where it is written otherwise.

    Null text is empty. Rows that repeat count each. Other columns are ignored.
    """
    field = fit(docs)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _find(field), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string"
    )
