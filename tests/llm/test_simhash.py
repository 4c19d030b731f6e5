from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from barhouse.llm import simhash
from tests.llm import small


def slow_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - 2)
    values = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def brute(pairs, bits=2):
    """(id, fp) to the smallest id reachable over all links."""
    label = {i: min((x[0] for x in pairs if x[1] == p[1] and x[0] is not None), default=None) for i, p in enumerate(pairs)}
    changed = True
    while changed:
        changed = False
        for i in label:
            for j in label:
                if (pairs[i][1] ^ pairs[j][1]).bit_count() <= bits and label[j] is not None:
                    if label[i] is None or label[j] < label[i]:
                        label[i], changed = label[j], True
    return sorted(((p[0], f"{p[1]:016x}", label[i]) for i, p in enumerate(pairs)), key=repr)


@pytest.mark.parametrize("crowd", [False, True])
def test_awkward_rows(spark, crowd):
    df = small.docs(spark)
    found = simhash.near_duplicates(small.crowded(df) if crowd else df)
    assert small.rows(found) == brute([(r[0], slow_fingerprint(r[1])) for r in small.AWKWARD])


def test_empty_table(spark):
    assert small.rows(simhash.near_duplicates(small.docs(spark, []))) == []


def test_links_between_chosen_fingerprints(spark, monkeypatch):
    """Near copies, chains and a crowd that shares a whole half, against all pairs."""
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(150):  # chains
        fps.append(rng.choice(fps[:100]) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    centre = rng.getrandbits(64)
    for _ in range(250):  # one half in common
        fps.append(centre ^ rng.getrandbits(32) & rng.getrandbits(32) & rng.getrandbits(32) & rng.getrandbits(32))
    pairs = list(enumerate(fps, 1000))
    signed = [(i, int(np.uint64(f).astype(np.int64))) for i, f in pairs]
    fixed = spark.createDataFrame([(*r, None) for r in signed], "doc_id long, fp long, own long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: fixed)
    assert small.rows(simhash.near_duplicates(fixed)) == brute(pairs)


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_long_runs_lose_no_pair(bits, monkeypatch):
    monkeypatch.setattr(simhash, "RUN", 4)
    rng = random.Random(bits)
    base = rng.getrandbits(64)
    fps = np.array(sorted({base ^ sum(1 << rng.randrange(64) for _ in range(3)) for _ in range(300)}), dtype=np.uint64)
    found = set()
    for slot in range(64):
        key = simhash._slot_key(fps, slot)
        for a, b in simhash.close_pairs(key, fps, bits, (0 if slot >= 32 else 32, 32)):
            found |= {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    want = {
        frozenset((a, b)) for a in fps.tolist() for b in fps.tolist() if a < b and (a ^ b).bit_count() <= bits
    }
    assert found == want


def test_one_of_each_group_stays(spark):
    df = small.crowded(small.docs(spark))
    groups = simhash.near_duplicates(df).collect()
    stay = simhash.drop_near_copies(df)
    assert stay.columns == df.columns
    assert {r.doc_id for r in stay.collect()} == {r.doc_id for r in groups if r.doc_id == r.component_id}


def test_rows_without_an_id_link_others(spark, monkeypatch):
    """A chain whose middle has no id, with its links in two tasks; and a group of such rows alone."""
    rng = random.Random(8)
    pairs = []
    for k in range(40):
        f = rng.getrandbits(64)
        low, high = 1 << rng.randrange(31), 1 << (32 + rng.randrange(31))
        pairs += [(2 * k, f), (None, f ^ 3 * low), (2 * k + 1, f ^ 3 * low ^ 3 * high)]
    pairs += [(None, rng.getrandbits(64))] * 2
    data = [(i, int(np.uint64(f).astype(np.int64)), None if i is not None else f % 1000) for i, f in pairs]
    fixed = spark.createDataFrame(data, "doc_id long, fp long, own long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, shingle: fixed)
    found = small.rows(simhash.near_duplicates(fixed))
    assert found == brute(pairs)
    assert [r[2] for r in found if r[0] is None].count(None) == 2


def test_rows_without_an_id_stay_only_by_themselves(spark):
    text = "alpha beta gamma delta epsilon zeta"
    data = [(5, text, "en", "a", 0), (None, text, "en", "a", 0), (None, "some other words of its own", "en", "a", 0)]
    stay = simhash.drop_near_copies(small.docs(spark, data)).collect()
    assert sorted(((r.doc_id, r.text) for r in stay), key=repr) == [(5, text), (None, data[2][1])]
