from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barhouse.llm import quality
from tests.llm import small

SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute(data, good_ids):
    """Counts, ratios and weights one n-gram at a time."""
    raw, target = {}, {}
    for i, text in data:
        for b in quality.grams(text).tolist():
            raw[b] = raw.get(b, 0) + 1
            target[b] = target.get(b, 0) + (i in good_ids)

    def ratio(b):
        inside = (lambda x: x < quality.BUCKETS) if b < quality.BUCKETS else (lambda x: x >= quality.BUCKETS)
        n = quality.BUCKETS if b < quality.BUCKETS else 2
        t, r = (sum(v for k, v in c.items() if inside(k)) for c in (target, raw))
        return math.log((target.get(b, 0) + 1) / (t + n)) - math.log((raw.get(b, 0) + 1) / (r + n))

    known = {b: ratio(b) for b in raw}
    return {i: sum(known[b] for b in quality.grams(t).tolist()) for i, t in data}


def test_weights_equal_brute_force(spark):
    data = [(1, "Plain words here."), (2, "junk*** text### !!"), (3, "More plain words."), (4, None), (5, "")]
    df = small.docs(spark, [(i, t, "en", "a", 0) for i, t in data])
    marks = labels(spark, [(1, 1, 0), (2, 0, 0), (3, 1, 0), (3, None, 0), (None, 1, 0), (77, 1, 0)])
    found = {r.doc_id: r.log_weight for r in quality.resample(small.crowded(df), marks).collect()}
    want = brute(data, {1, 3})
    assert found.keys() == want.keys()
    assert all(found[i] == pytest.approx(want[i]) for i in want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    kept = {r.doc_id for r in quality.resample(docs, marks.where("doc_id % 2 = 1")).where("kept").collect()}
    held = marks.where("doc_id % 2 = 0").collect()
    good = [r.doc_id for r in held if r.quality == 1]
    bad = [r.doc_id for r in held if r.quality == 0]
    assert sum(i in kept for i in good) / len(good) > 0.99
    assert sum(i in kept for i in bad) / len(bad) < 0.02


def test_kth_largest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "_FINAL_ROWS", 20)
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.normal(size=900), np.full(300, 0.25), rng.normal(size=100) * 1e6])
    df = spark.createDataFrame([(float(v),) for v in values], "key double")
    ordered = np.sort(values)[::-1]
    for k in (1, 50, 51, 300, 700, 1300):
        assert quality.kth_largest(df, k) == ordered[k - 1]
    assert quality.kth_largest(df, 1301) == -math.inf


def test_top_k(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    marks = spark.read.parquet(f"{SF}/labels.parquet")
    found = quality.resample(df, marks, k=123).collect()
    kept = sorted((r.key for r in found), reverse=True)[:123]
    assert sorted((r.key for r in found if r.kept), reverse=True) == kept


def test_gumbel_noise(spark):
    noise = [r[0] for r in spark.range(20_000).select(quality.gumbel(F.col("id"))).collect()]
    assert np.mean(noise) == pytest.approx(0.5772, abs=0.05)
    assert np.std(noise) == pytest.approx(math.pi / math.sqrt(6), abs=0.05)


@pytest.mark.parametrize("marks", [[], [(1, 0, 0)], [(10, 1, 0), (11, 0, 0), (30, 1, 0), (30, 0, 0)]])
def test_awkward_rows(spark, marks):
    df = small.crowded(small.docs(spark))
    found = quality.resample(df, labels(spark, marks)).collect()
    assert len(found) == len(small.AWKWARD)
    stay = quality.keep_quality(df, labels(spark, marks))
    assert stay.columns == df.columns
    assert stay.count() == sum(r.kept for r in found)
    if len(marks) < 2:
        assert stay.count() == len(small.AWKWARD)


def test_empty_table(spark):
    assert quality.resample(small.docs(spark, []), labels(spark, [(1, 1, 0)])).collect() == []

