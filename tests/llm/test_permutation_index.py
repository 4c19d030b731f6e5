from __future__ import annotations

import math

import numpy as np
import pytest

import __spark_entry__ as contract
from barhouse.llm import permutation_index as index
from tests.llm import small


def brute(data, k=20, every=20):
    """(query, rank) -> (id, score), by every inner product."""
    use = {}
    for i, v in data:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        whole = [float(np.float32(x)) for x in v]
        use[i] = min(use.get(i, whole), whole)
    out = {}
    for q in use:
        if q % every == 0:
            scores = [
                (-float((np.array(use[q]) * np.array(v)).sum()), i) for i, v in use.items() if i != q and len(v) == len(use[q])
            ]
            for r, (s, i) in enumerate(sorted(scores)[:k]):
                out[q, r + 1] = (i, -s)
    return out


def run(spark, data, **options):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    return {(r[0], r[1]): (r[2], r[3]) for r in index.nearest(small.crowded(df), **options).collect()}


def recall(found, want):
    got, true = {(q, i) for (q, _), (i, _) in found.items()}, {(q, i) for (q, _), (i, _) in want.items()}
    return len(got & true) / len(true)


def check_form(found, data, k=20):
    """Ranks from 1 without gaps, scores of the very vectors, best first and ties to the smaller id."""
    vectors = {i: np.array(v, dtype=np.float32).astype(np.float64) for i, v in data}
    by_query = {}
    for (q, rank), (i, score) in sorted(found.items()):
        by_query.setdefault(q, []).append((-score, i))
        assert rank == len(by_query[q]) <= k and i != q
        assert score == pytest.approx(float(vectors[q] @ vectors[i]), rel=1e-12, abs=1e-12)
    for rows in by_query.values():
        assert rows == sorted(rows) and len({i for _, i in rows}) == len(rows)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_given_tables(spark, sf):
    folder = f"/root/testdata/{sf}"
    data = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = {(r[0], r[1]): (r[2], r[3]) for r in contract.queries()["op13_permutation_index"](spark, folder).collect()}
    want = brute(data)
    check_form(found, data)
    assert found.keys() == want.keys()
    assert recall(found, want) >= 0.93


def test_clusters_need_few_candidates(spark, monkeypatch):
    monkeypatch.setattr(index, "SHARD", 1500)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 24))
    data = [(i, (centres[i % 60] + 0.1 * rng.normal(size=24)).tolist()) for i in range(6000)]
    shares = []
    fit = index.PermutationIndex.fit_share
    monkeypatch.setattr(index.PermutationIndex, "fit_share", lambda self, q: shares.append(fit(self, q)))
    found = run(spark, data, every=50)
    check_form(found, data)
    assert recall(found, brute(data, every=50)) >= 0.9
    assert shares[0] < 0.1


def test_long_vectors_win(spark):
    """Inner products are not distances: the nearest of all queries may be the longest vectors."""
    rng = np.random.default_rng(6)
    data = [(i, (rng.normal(size=8) * rng.choice([0.1, 1, 9])).tolist()) for i in range(1500)]
    found = run(spark, data)
    check_form(found, data)
    assert recall(found, brute(data)) >= 0.9


def test_awkward_rows(spark):
    v = [0.5, -0.25, 1.0]
    data = [
        (0, v), (20, [1.0, 1.0, 1.0]), (1, None), (2, [0.5, None, 1.0]), (3, [0.5, math.nan, 1.0]), (40, [0.0, 0.0, 0.0]),
        (4, [math.inf, 0.0, 0.0]), (None, v), (5, v), (5, v), (5, [9.0, 9.0, 9.0]), (6, [1.0, 2.0]), (60, [3.0, 4.0]),
        (80, []), (7, []), (100, [1e5, 1e5]), (101, [3e5, -1e5]), (-20, v), (9, [-0.5, 0.25, -1.0]), (120, [1.0]),
    ]
    assert run(spark, data) == brute(data)


def test_ties_repeats_and_empty(spark):
    data = [(i, [1.0, 2.0]) for i in range(100)] + [(7, [1.0, 2.0])] * 300
    assert run(spark, data) == brute(data)
    assert run(spark, [(20, [1.0])]) == {}
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == {}
    assert run(spark, []) == {}
