from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from barhouse.llm import exact_dedup
from tests.llm import small


def brute(data):
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in data]
    out = []
    for r, b in zip(data, body):
        ids = [x[0] for x, y in zip(data, body) if y == b]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(b.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_awkward_rows(spark):
    assert small.rows(exact_dedup.exact_groups(small.crowded(small.docs(spark)))) == brute(small.AWKWARD)


def test_colliding_hashes_are_told_apart_by_their_bytes(spark):
    found = exact_dedup.exact_groups(small.docs(spark), content_hash=lambda t: F.length(t) % 2)
    assert small.rows(found) == brute(small.AWKWARD)


def test_empty_table(spark):
    assert small.rows(exact_dedup.exact_groups(small.docs(spark, []))) == []
    assert small.rows(exact_dedup.drop_exact_copies(small.docs(spark, []))) == []


def test_rows_that_stay(spark):
    df = small.crowded(small.docs(spark))
    stay = exact_dedup.drop_exact_copies(df)
    assert stay.columns == df.columns
    ids = sorted((r.doc_id, r.text) for r in stay.collect() if r.doc_id is not None)
    assert [i for i, _ in ids] == [3, 7, 9, 11, 12, 13, 20, 21, 30, 31, 31]
    assert [r.text for r in stay.collect() if r.doc_id is None] == ["only without an id"]
