from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from barhouse.llm import suffix_dedup
from tests.llm import small

MATCH = 50


def brute(data, match=MATCH):
    """(id, length, removed, spans, sha256 of the rest) by a table of all strings of ``match`` bytes."""
    far = 1 << 62
    bodies = [((far if r[0] is None else r[0]), (r[1] or "").encode()) for r in data]
    least = {}
    for i, b in bodies:
        for s in range(len(b) - match + 1):
            least[b[s : s + match]] = min(i, least.get(b[s : s + match], far))
    out = []
    for i, b in bodies:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for s in range(len(b) - match + 1):
            if least[b[s : s + match]] < i:
                gone[s : s + match] = True
        gone = gone[: len(b)]
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((None if i == far else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df, **options):
    got = suffix_dedup.remove_repeats(df, **options).collect()
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got), key=repr
    )


def passages(seed, n=260):
    """Documents that share passages, whole texts, long runs of one letter and near misses of 49 bytes."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(300)]
    shared = [" ".join(rng.choices(words, k=rng.randint(5, 60))) for _ in range(12)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(0, 80)))
        for _ in range(rng.randint(0, 3)):
            piece = rng.choice(shared)
            a = rng.randrange(len(piece))
            text += rng.choice(["", " ", "|"]) + piece[a : a + rng.randint(30, 200)] + rng.choice(["", "x"])
        if i % 9 == 0:
            text += "z" * rng.randint(40, 400)
        if i % 17 == 0:
            text += "ab" * rng.randint(10, 200)
        if i % 11 == 0 and rows:
            text = rng.choice(rows)[1]
        rows.append((rng.randrange(10_000) if i % 5 else i, text, "en", "a", 0))
    base = "".join(rng.choices("abcdefgh", k=49))
    rows += [(20_000, base + "1", "en", "a", 0), (20_001, base + "2", "en", "a", 0), (20_002, "x" + base + "1", "en", "a", 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(suffix_dedup, "HOME_BITS", 1)
    data = passages(seed)
    assert found(small.docs(spark, data).repartition(3), n_batches=5) == brute(data)


def test_one_batch_gives_the_same(spark):
    data = passages(3, 60)
    df = small.docs(spark, data)
    assert found(df, n_batches=1) == found(df.repartition(4), n_batches=7) == brute(data)


def test_colliding_hashes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_hash_rows", lambda lanes: lanes[:, 0] % np.uint64(3))
    data = passages(4, 50)
    want = brute(data)
    assert found(small.docs(spark, data)) == want


def test_awkward_rows(spark):
    assert found(small.crowded(small.docs(spark))) == brute(small.AWKWARD)


def test_other_lengths(spark):
    data = passages(5, 60)
    assert found(small.docs(spark, data), match=30) == brute(data, 30)


def test_empty_table(spark):
    assert found(small.docs(spark, [])) == []
    assert found(small.docs(spark, [(1, None, "en", "a", 0)])) == brute([(1, None)])


def test_every_string_has_an_anchor_that_depends_on_it_alone():
    rng = np.random.default_rng(1)
    body = rng.integers(97, 100, 3000).astype(np.uint8)
    ends = np.array([5, 5, 700, 749, 3000])
    at, _ = suffix_dedup.anchors(body, ends, MATCH)
    at = set(at.tolist())
    starts = [0, 5, 5, 700, 749]
    for a, b in zip(starts, ends.tolist()):
        for s in range(a, b - MATCH + 1):
            alone, _ = suffix_dedup.anchors(body[s : s + MATCH], np.array([MATCH]), MATCH)
            assert len(alone) and {s + x for x in alone.tolist()} <= at


def test_every_batch_gets_blocks(spark):
    """Tables of several input partitions fill all batches, so arrays meet levels however small the partitions are."""
    data = [(i, f"text {i} of a small partition", "en", "a", 0) for i in range(60)]
    blocks = small.docs(spark, data).repartition(6).select("doc_id", "text").mapInArrow(
        suffix_dedup._to_blocks(suffix_dedup.BATCHES), suffix_dedup._BLOCK_SQL
    )
    assert {r.batch for r in blocks.select("batch").distinct().collect()} == set(range(suffix_dedup.BATCHES))
