from __future__ import annotations

import math

import numpy as np
import pytest

from barhouse.llm import topk
from tests.llm import small


def brute(data, k=10, every=100):
    use = {}
    for i, v in sorted(data, key=lambda r: (r[0] is None, r[0] or 0)):
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(1024 * float(np.float32(x))) for x in v]
        use[i] = min(use.get(i, whole), whole)
    out = []
    for q in use:
        if q % every == 0:
            scores = [(-sum(a * b for a, b in zip(use[q], v)), i) for i, v in use.items() if i != q and len(v) == len(use[q])]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def run(spark, data, **options):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    return sorted(tuple(r) for r in topk.top_k(small.crowded(df), **options).collect())


@pytest.mark.parametrize("shard", [7, 64, 4096])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rng = np.random.default_rng(shard)
    data = [(i, rng.normal(size=6).round(1).astype(np.float32).tolist()) for i in range(0, 900, 3)]
    data += [(i, data[0][1]) for i in range(1, 200, 3)]  # many ties
    assert run(spark, data) == brute(data)


def test_awkward_rows(spark):
    v = [0.5, -0.25, 1.0]
    data = [
        (0, v), (100, [1.0, 1.0, 1.0]), (1, None), (2, [0.5, None, 1.0]), (3, [0.5, math.nan, 1.0]),
        (4, [math.inf, 0.0, 0.0]), (None, v), (5, v), (5, v), (6, [1.0, 2.0]), (200, [3.0, 4.0]), (300, []), (7, []),
        (400, [1e5, 1e5]), (401, [3e5, -1e5]), (-100, v),
    ]
    assert run(spark, data) == brute(data)


def test_fewer_than_k_and_empty(spark):
    assert run(spark, [(100, [1.0]), (1, [2.0])]) == [(100, 1, 1, 1024 * 2048)]
    assert run(spark, [(100, [1.0])]) == []
    assert run(spark, []) == []
