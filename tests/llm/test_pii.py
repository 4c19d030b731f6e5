from __future__ import annotations

import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barhouse.llm import pii
from tests.llm import small

CONTRACT = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def check_digits(digits):
    odd = sum(int(d) for d in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in enumerate(CONTRACT):
        for m in re.finditer(pattern, text):
            digits = [c for c in m[0] if c in "0123456789"]
            good = (
                kind == 0
                or (kind == 1 and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == 2 and 13 <= len(digits) <= 19 and check_digits(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            )
            if good:
                out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from([*"ab.@-+ 0127()é_%\n\t", "4111111111111111", "1.2.3.4", "x@y.zz", "٣"]), max_size=40))
def test_patterns_equal_the_contract(parts):
    text = "".join(parts)
    assert pii.base_spans(text)[0] == brute(text)


def run(df):
    return {r.doc_id: r for r in pii.personal_data(df).collect()}


CORPUS = [
    (i, f"call +1 (269) 555-{1000 + i} or write a{i}.b@mail.example.com from 10.0.{i % 256}.7 with 4111111111111111 v {i}", "en", "a", 0)
    for i in range(200)
] + [(1000 + i, f"version {i}.{i % 7} of {i * 31} things in {1900 + i % 100}", "en", "a", 0) for i in range(200)]


def test_labels_carry_over_to_distant_mentions(spark):
    text = "reach +1 (543) 555-9258 today; " + "plain words " * 40 + "so (543) 555-9258 again, not 2024"
    found = run(small.docs(spark, [*CORPUS, (9000, text, "en", "a", 0)]))
    row = found[9000]
    again = text.rindex("543")
    assert row.n_phone == 1
    kind, start, end = row.spans.split(",")[-1].split(":")
    assert kind == "phone" and again - 1 <= int(start) <= again and text[: int(end)].endswith("555-9258")
    assert "2024" not in [text[int(a) : int(b)] for _, a, b in (s.split(":") for s in row.spans.split(","))]


def test_base_spans_stay_and_clean_documents_stay_clean(spark):
    found = run(small.docs(spark, CORPUS))
    for i, text, *_ in CORPUS:
        base = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute(text)]
        assert found[i].base == ",".join(base)
        assert set(base) <= set(found[i].spans.split(",")) or not base
        if i >= 1000:
            assert found[i].spans == ""


def test_awkward_rows(spark):
    data = [*small.AWKWARD, (50, "é\U0001f600 x@y.zz " * 3, None, None, None), (51, "9" * 50_000 + "@" + "a." * 20_000, "", "", 0)]
    got = pii.personal_data(small.crowded(small.docs(spark, data))).collect()
    want = sorted(((r[0], ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in brute(r[1] or ""))) for r in data if r[0] != 51), key=repr)
    assert sorted(((r.doc_id, r.base) for r in got if r.doc_id != 51), key=repr) == want


def test_empty_table(spark):
    assert pii.personal_data(small.docs(spark, [])).collect() == []


def test_messages_give_exact_marginals_on_a_chain():
    rng = np.random.default_rng(2)
    size = len(pii.LABELS)
    field = pii.Field(rng.normal(size=(pii.FEATURES, size)), rng.normal(size=(size, size)), rng.normal(size=(size, size)))
    nodes = pii.Nodes([(0, 1)] * 4, [[1], [2], [3], [4]], [(0, 1), (1, 2)], [(2, 3)], [-1, -1, -1, 2])
    want = np.zeros((4, size))
    for y in np.ndindex(*[size] * 4):
        if y[3] == 2:
            p = np.exp(sum(field.unary[i + 1, y[i]] for i in range(3)) + field.chain[y[0], y[1]] + field.chain[y[1], y[2]] + field.skip[y[2], y[3]])
            for i in range(4):
                want[i, y[i]] += p
    assert field.labels(nodes) == pytest.approx(want / want.sum(axis=1, keepdims=True), abs=0.02)


def test_parts_of_very_many_digits():
    zeros, ones = "0" * 5000 + "1.2.3.4", "1" * 5000 + ".2.3.4"
    assert pii.base_spans(zeros)[0] == [(1, 0, len(zeros))]
    assert pii.base_spans(ones)[0] == []


def planted(n):
    """Documents with a mention that a pattern finds and one that none does, and tokens that look alike."""
    rng = np.random.default_rng(4)
    data, want = [], set()
    names = ["anna", "boris", "chandra", "dmitri", "elena", "farid", "greta", "hugo"]
    for i in range(n):
        doc_id = 50_000 + i
        filler = " ".join(rng.choice(["plain", "words", "about", "nothing", "of", "note"], 30).tolist())
        if i % 2:
            local = f"{names[i % 8]}.{names[i // 8 % 8]}{rng.integers(10, 99)}"
            first, again, kind = f"{local}@mail{i % 9}.example.com", local, "email"
        else:
            tail = f"{rng.integers(200, 999)}-{rng.integers(200, 999)}-{rng.integers(1000, 9999)}"
            first, again, kind = f"+1 {tail}", tail, "phone"
        text = f"reach {first} today {filler} and once more {again} then room {rng.integers(10, 999)} in {rng.integers(1900, 2030)}"
        data.append((doc_id, text, "en", "a", 0))
        at = text.rindex(again)
        want.add((doc_id, f"{kind}:{at}:{at + len(again)}"))
    return data, want


def test_added_spans_are_the_planted_mentions(spark):
    data, want = planted(300)
    rows = pii.personal_data(small.docs(spark, [*CORPUS, *data])).collect()
    added = {(r.doc_id, s) for r in rows for s in set(r.spans.split(",")) - set(r.base.split(",")) if s}
    hit = len(added & want)
    print("recall", hit / len(want), "precision", hit / max(1, len(added)))
    assert hit / len(want) >= 0.9 and hit / len(added) >= 0.9
