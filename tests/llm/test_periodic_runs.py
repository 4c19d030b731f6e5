from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from barhouse.llm import periodic_runs
from tests.llm import small


def brute_runs(w, least=2):
    """Every stretch that keeps a period and is two periods long, of which no smaller period holds."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            n = j - i + q
            if n >= max(least, 2 * q) and not any(all(w[x] == w[x + p] for x in range(i, i + n - p)) for p in range(1, q)):
                out.append((i, n, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def contract_words(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is None or not n:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(data):
    out = []
    for doc_id, text, *_ in data:
        w = contract_words(doc_id, text)
        runs = brute_runs(w, 12)
        gone = {i for s, n, p in runs for i in range(s + p, s + n)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        s, n, p = best or (None, None, None)
        out.append(
            (
                doc_id, len(runs), s, n, p, best and 1000 * n // p,
                sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
                sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
            )
        )
    return sorted(out, key=repr)


@given(st.lists(st.integers(0, 3), max_size=60))
@settings(max_examples=300, deadline=None)
def test_automaton_finds_all_runs(words):
    assert sorted(periodic_runs.runs_of(words), key=lambda r: (r[0], r[2])) == brute_runs(words)


def test_long_periods_and_powers():
    rng = random.Random(3)
    for _ in range(60):
        block = [rng.randrange(6) for _ in range(rng.randrange(1, 40))]
        words = [9] * rng.randrange(4) + block * rng.randrange(2, 7) + block[: rng.randrange(len(block) + 1)] + [8, 9, 9]
        assert sorted(periodic_runs.runs_of(words), key=lambda r: (r[0], r[2])) == brute_runs(words)
    assert periodic_runs.runs_of([5] * 50_000) == [(0, 50_000, 1)]


@pytest.mark.parametrize("least", [2, 3, 5, 12])
def test_no_run_leaves_its_stretch(least):
    rng = random.Random(least)
    for _ in range(200):
        docs = [[rng.randrange(3) for _ in range(rng.randrange(50))] for _ in range(4)]
        docs.append((docs[0][:9] or [1]) * 4)
        ids = np.array([w for d in docs for w in d])
        owner = np.repeat(np.arange(5), [len(d) for d in docs])
        found = []
        for a, b in periodic_runs.stretches(ids, owner, least):
            assert owner[a] == owner[b - 1]
            found += [(s + a, n, p) for s, n, p in periodic_runs.runs_of(ids[a:b].tolist()) if n >= least]
        first = np.cumsum([0] + [len(d) for d in docs])
        want = [(s + first[k], n, p) for k, d in enumerate(docs) for s, n, p in brute_runs(d, least)]
        assert sorted(found) == sorted(want)


def rows_of(spark, tmp_path, data):
    small.crowded(small.docs(spark, data)).write.parquet(f"{tmp_path}/documents.parquet")
    return small.rows(contract.queries()["op11_periodic_runs"](spark, str(tmp_path)))


def test_query_equals_brute_force(spark, tmp_path):
    given_rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()
    data = [tuple(r) for r in given_rows if len(r[1]) < 4000]
    line = "all rights reserved by the owner of this page "
    short = [r for r in small.AWKWARD if len(r[1] or "") < 1000]
    data += short + [
        (500_001, line * 7, "en", "a", 1),
        (500_002, "go " * 11, "en", "a", 1),
        (500_003, "go " * 12, "en", "a", 1),
        (500_004, "x y " * 6 + "z " + "x y " * 6, "en", "a", 1),
        (500_005, "a\x0bb\x0cc d\x1ce " * 9 + " ", "en", "a", 1),
        (500_006, " " + line * 2 + "end " + line * 2, "en", "a", 1),
        (None, line * 3, "en", "a", 1),
        (30, line * 3, "en", "a", 1),
    ]
    found = rows_of(spark, tmp_path, data)
    assert found == brute(data)
    assert sum(r[1] > 0 for r in found) > 20


def test_long_text_and_empty_table(spark, tmp_path):
    block = [f"w{i * 7919 % 5003}" for i in range(5003)]
    long = " ".join(["start", *block * 12, "end"])
    found = periodic_runs.periodic_runs(small.docs(spark, [(1, long, "en", "a", 0), (2, small.LONG, "en", "a", 0)]))
    by_id = {r.doc_id: r for r in found.collect()}
    assert [tuple(r) for r in by_id[1].runs] == [(1, 12 * 5003, 5003)]
    assert by_id[1].collapsed == " ".join(["start", *block, "end"])
    assert [tuple(r) for r in by_id[2].runs] == [(0, 30_000, 5003)]
    assert rows_of(spark, tmp_path, []) == []


def test_slices_give_the_same(spark, monkeypatch):
    data = [r for r in small.AWKWARD] + [(900 + i, "one two three four " * i, "en", "a", 0) for i in range(20)]
    whole = small.rows(periodic_runs.digests(periodic_runs.periodic_runs(small.docs(spark, data))))
    monkeypatch.setattr(periodic_runs, "SLICE_BYTES", 50)
    assert small.rows(periodic_runs.digests(periodic_runs.periodic_runs(small.docs(spark, data)))) == whole
