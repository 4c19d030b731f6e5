"""Alignment of two tokenizers' tokens of the same text, and how often two ids stand together.

Every token gets the byte offset at which it ends. Both lists of ends rise, and a group is what lies
between two offsets at which tokens of both tokenizers end. Along a stretch of one-to-one groups the
indices of both lists differ by the same shift, so a stretch is skipped along that diagonal: slices of
doubled size are compared at the current shift until they differ, then slices of halved size. What follows
is an irregular group, which is walked token by token and leaves a new shift.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch, held, slices

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
#: Text that is encoded together; block of rows that share a table of pairs.
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 4 << 20
#: Pairs whose text a Python worker remembers.
KNOWN_PAIRS = 1_000_000
#: Longer texts are encoded in parts of about this many characters.
PART_CHARS = 1 << 16
#: Where a text can be cut: no token of either tokenizer goes across a single space in front.
_CUT = re.compile("(?<=[^\\s▁]) (?=[^\\s▁])")
#: Fixed value: how the byte-level vocabulary cuts a text.
_BYTE_LEVEL_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder(Protocol):
    """A tokenizer: the bytes of every id, and the ids of texts, each with a space in front."""

    pieces: list[bytes]

    def encode(self, texts: list[str]) -> list[np.ndarray]: ...


class ByteLevel:
    """A byte-level BPE vocabulary, as a tokenizers file has it, encoded by tiktoken's merge loop.

    Merges by rank give the same tokens as the file's list of merges if that list is in the order of the
    ids, which is checked here. Special tokens are not known, so their names are plain text.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"] for t in content["added_tokens"]}
        vocab = {token: n for token, n in content["model"]["vocab"].items() if token not in special}
        merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in content["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"the merges of {path} are not in the order of their ids")
        # Printable bytes stand for themselves, the others for the characters from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)).difference(plain)))}
        ranks = {bytes(map(byte_of.__getitem__, token)): n for token, n in vocab.items()}
        self.encoding = tiktoken.Encoding("byte level", pat_str=_BYTE_LEVEL_PARTS, mergeable_ranks=ranks, special_tokens={})
        self.pieces = [b""] * (max(ranks.values()) + 1)
        for token, n in ranks.items():
            self.pieces[n] = token

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        encode = self.encoding.encode_ordinary
        return [np.array(encode(" " + t), dtype=np.int64) for t in texts]


class Pieces:
    """A sentencepiece model, which puts the space in front itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        ids = range(self.model.vocab_size())
        self.pieces = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in ((i, self.model.id_to_piece(i)) for i in ids)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int64) for ids in self.model.encode(texts, num_threads=1)]


def public_encoders() -> tuple[Encoder, Encoder]:
    import public_tokenizers

    return ByteLevel(public_tokenizers.path(BYTE_LEVEL)), Pieces(public_tokenizers.path(PIECES))


def parts_of(text: str) -> list[str]:
    """The text in parts of about ``PART_CHARS``, without the single spaces between them."""
    parts, start = [], 0
    while len(text) - start > PART_CHARS:
        cut = _CUT.search(text, start + PART_CHARS)
        if not cut:
            break
        parts.append(text[start : cut.start()])
        start = cut.end()
    return [*parts, text[start:]]


def encode_whole(encoder: Encoder, texts: list[str]) -> list[np.ndarray]:
    """Ids of whole texts, long ones part by part."""
    parts = [parts_of(t) for t in texts]
    found = iter(encoder.encode([p for each in parts for p in each]))
    return [np.concatenate([next(found) for _ in each]) for each in parts]


#: The first slice that is compared along a diagonal.
FIRST_STEP = 4


def stretches(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """(i, j, n): n groups that end after i + 1, i + 2, ... tokens of a and j + 1, j + 2, ... of b, in order.

    The first group of a stretch may begin earlier: it is the irregular one that leads to the new shift. Ends
    rise, and the last ones are equal. Slices are compared as bytes, eight to an end.
    """
    a, b = ends_a.tolist(), ends_b.tolist()
    raw_a, raw_b = ends_a.astype("<i8").tobytes(), ends_b.astype("<i8").tobytes()
    from_a: list[int] = []
    from_b: list[int] = []
    sizes: list[int] = []
    i = j = 0
    n = len(a)
    while i < n:
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        start = i
        from_a.append(i)
        from_b.append(j)
        i += 1
        j += 1
        step = FIRST_STEP
        while i < n and raw_a[8 * i : 8 * (i + step)] == raw_b[8 * j : 8 * (j + step)]:
            i += step
            j += step
            step *= 2
        if i < n:
            while step := step // 2:
                if raw_a[8 * i : 8 * (i + step)] == raw_b[8 * j : 8 * (j + step)]:
                    i += step
                    j += step
        else:
            i = n
        sizes.append(i - start)
    return from_a, from_b, sizes


def group_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each list every group ends after."""
    from_a, from_b, sizes = (np.array(x, dtype=np.int64) for x in stretches(a, b))
    total = int(sizes.sum())
    along = np.arange(1, total + 1) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(from_a, sizes) + along, np.repeat(from_b, sizes) + along


class Written(dict):
    """One-to-one groups as text, by their pair."""

    def __init__(self, width: int):
        self.width = width

    def __missing__(self, pair: int) -> str:
        self[pair] = text = f"{pair // self.width}|{pair % self.width}"
        return text


class Joined:
    """The bytes of lists of ids."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.body = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.body[at].tobytes()


class Aligner:
    """Two encoders with what is needed of their vocabularies."""

    def __init__(self, encoders: tuple[Encoder, Encoder]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encoders = encoders
        self.joined = [Joined(e.pieces) for e in encoders]
        self.numbers = [[str(i) for i in range(len(e.pieces))] for e in encoders]
        #: A pair of ids is the number a * width + b.
        self.width = len(encoders[1].pieces)
        self.kind = "<u4" if len(encoders[0].pieces) * self.width <= 1 << 32 else "<u8"
        self.known = Written(self.width)

    def _tokens(self, side: int, texts: list[str], wanted: list[bytes]) -> list[np.ndarray | None]:
        """Ids of the texts; None where their bytes are not the text's, or a token has none."""
        joined = self.joined[side]
        found = encode_whole(self.encoders[side], texts)
        good = (joined.bytes_of(ids) == want and joined.sizes[ids].all() for ids, want in zip(found, wanted))
        return [ids if g else None for ids, g in zip(found, good)]

    def groups(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None]:
        """Per text: both lists of ids and where its groups end; None for texts without tokens."""
        full = [k for k, t in enumerate(texts) if t]
        some = [texts[k] for k in full]
        wanted = [b" " + t.encode() for t in some]
        out: list = [None] * len(texts)
        for k, a, b in zip(full, self._tokens(0, some, wanted), self._tokens(1, some, wanted)):
            if a is not None and b is not None:
                ends = group_ends(*(np.cumsum(x.sizes[ids]) for x, ids in zip(self.joined, (a, b))))
                out[k] = (a, b, *ends)
        return out

    def pairs(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
        """The pairs of ids that end together. No token is empty, so each group has one: its last tokens."""
        return a[ends_a - 1] * self.width + b[ends_b - 1]

    def written(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, pairs: np.ndarray) -> str:
        """Groups as text: ``a1,a2|b1;a3|b2,b3``."""
        if len(self.known) > KNOWN_PAIRS:
            self.known.clear()
        out = list(map(self.known.__getitem__, pairs.tolist()))
        odd = np.flatnonzero((np.diff(ends_a, prepend=0) > 1) | (np.diff(ends_b, prepend=0) > 1))
        if len(odd):
            x, y = a.tolist(), b.tolist()
            of_x, of_y = (numbers.__getitem__ for numbers in self.numbers)
            before = [np.append(0, e)[odd].tolist() for e in (ends_a, ends_b)]
            for g, i, p, j, q in zip(odd.tolist(), before[0], ends_a[odd].tolist(), before[1], ends_b[odd].tolist()):
                out[g] = f"{','.join(map(of_x, x[i:p]))}|{','.join(map(of_y, y[j:q]))}"
        return ";".join(out)


_ALIGNED = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups", pa.string()), ("links", pa.binary())]
)
_ALIGNED_SQL = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary"


def _aligner(make: Callable[[], tuple[Encoder, Encoder]]) -> Aligner:
    return held(f"cross_align {make.__module__}.{make.__qualname__}", lambda: Aligner(make()))


def _align(make: Callable[[], tuple[Encoder, Encoder]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(make)
        first, made, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            for some in slices(batch, 1, SLICE_BYTES):
                if size >= BLOCK_BYTES:
                    made, size = made + 1, 0
                texts = [t or "" for t in some.column(1).to_pylist()]
                size += some.column(1).nbytes
                rows = []
                for found in aligner.groups(texts):
                    if found is None:
                        rows.append((0, 0, 0, 0, "", b""))
                    else:
                        n, pairs = len(found[2]), aligner.pairs(*found)
                        links = pairs.astype(aligner.kind).tobytes()
                        rows.append((len(found[0]), len(found[1]), n, n, aligner.written(*found, pairs), links))
                columns = [pa.array([first + made] * len(rows), pa.int64()), some.column(0)]
                columns += [pa.array(c, f.type) for c, f in zip(zip(*rows), list(_ALIGNED)[2:])]
                yield pa.RecordBatch.from_arrays(columns, schema=_ALIGNED)

    return run


def align(docs: DataFrame, make: Callable[[], tuple[Encoder, Encoder]] = public_encoders) -> DataFrame:
    """(block, doc_id, n_a, n_b, n_groups, n_links, groups, links): one row per row.

    ``groups`` has the ids of the groups in order, as ``a1,a2|b1;a3|b2,b3``. ``links`` packs the pairs of
    ids whose tokens end together; ``block`` names rows whose pairs are counted together.

    ``make`` builds both encoders where they run. A null or empty text has no tokens, and so has one whose
    tokens, of either encoder, do not join to the text with a space in front: zeros, an empty ``groups``
    and no links. Rows are independent of one another, so rows without an id and repeated rows get their
    own result. Other columns are ignored. There is no shuffle; long texts are encoded part by part.
    """
    kept = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(_align(make), _ALIGNED_SQL)


_PARTIAL = pa.schema([("block", pa.int64()), ("pair", pa.int64()), ("n", pa.int64())])


def _joined(links: pa.Array, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(links.to_pylist()), dtype=kind).astype(np.int64)


def _partial(make: Callable[[], tuple[Encoder, Encoder]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _aligner(make).kind
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            for block in np.unique(blocks).tolist():
                own = batch.column(1).filter(pa.array(blocks == block))
                pairs, n = np.unique(_joined(own, kind), return_counts=True)
                columns = [pa.array(np.full(len(pairs), block)), pa.array(pairs), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, schema=_PARTIAL)

    return run


def _score(kind: str):
    """Per row of a block: how many of its links are their B id's most frequent, and the sum of their counts."""

    def run(key: tuple, rows: pa.Table, values: pa.Table) -> pa.Table:
        pairs, at = np.unique(values["pair"].to_numpy(), return_index=True)
        count = values["count"].to_numpy()[at]
        best = values["best"].to_numpy()[at].astype(np.int64)
        links = rows["links"].combine_chunks()
        width = np.dtype(kind).itemsize
        sizes = np.array([len(x) // width for x in links.to_pylist()], dtype=np.int64)
        place = np.searchsorted(pairs, _joined(links, kind))
        ends = np.append(0, np.cumsum(sizes))
        out = rows.drop_columns(["block", "links"])
        for name, value in (("n_best", best), ("count_sum", count)):
            total = np.append(0, np.cumsum(value[place])).astype(np.int64)
            out = out.append_column(name, pa.array(total[ends[1:]] - total[ends[:-1]]))
        return out

    return run


def pair_counts(aligned: DataFrame, make: Callable[[], tuple[Encoder, Encoder]] = public_encoders) -> DataFrame:
    """(block, pair, n): links of each pair of ids within (a part of) a block. A pair is a * width + b."""
    return aligned.select("block", "links").mapInArrow(_partial(make), "block long, pair long, n long")


def link_statistics(
    aligned: DataFrame, scratch: Scratch, make: Callable[[], tuple[Encoder, Encoder]] = public_encoders
) -> DataFrame:
    """``aligned`` without block and links, with ``n_best`` and ``count_sum``, by the links of all rows.

    A pair's count is how many links hold it. ``count_sum`` adds the counts of a row's links, ``n_best`` is
    how many of them have the highest count of all pairs with their B id, ties included; both are 0 for
    rows without links. ``aligned`` is read twice and is to be written down by the caller.

    Links are counted within blocks first, so a pair crosses the shuffle once per block however often it
    occurs, and the values come back to a block once per pair; rows move once, by their block.
    """
    aligner = _aligner(make)
    b_id: Column = F.pmod("pair", F.lit(aligner.width))
    partial = scratch.keep(pair_counts(aligned, make))
    counts = scratch.keep(partial.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b_id", b_id))
    most = counts.groupBy("b_id").agg(F.max("count").alias("most"))
    values = counts.join(most, "b_id").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = partial.select(F.col("block").alias("block_v"), "pair").join(values, "pair")
    out = [f for f in aligned.schema if f.name not in ("block", "links")]
    sql = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out)
    tiles = aligned.groupBy("block").cogroup(back.groupBy("block_v"))
    return tiles.applyInArrow(_score(aligner.kind), f"{sql}, n_best long, count_sum long")
