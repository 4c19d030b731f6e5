from __future__ import annotations

from collections import defaultdict

import pytest

from barhouse.llm import mixing
from tests.llm import small


def test_targets_and_taken_words(spark):
    data = [(i, "w " * (1 + i % 50), "en", "src%d" % (i % 7 if i % 3 else 0), 0) for i in range(2000)]
    data += [(5000 + i, "x " * 3, "en", None, 0) for i in range(5)]
    found = mixing.mix(small.docs(spark, data)).collect()
    assert len(found) == len(data)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    total = sum(size.values())
    weights = dict(zip(sorted(s for s in size if s) + [None], [3, 1, 2] * 3))
    want, open_ = {}, set(size)
    while True:  # pour, cap, pour the rest again
        left = 1.5 * total - sum(want.values())
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * size[s]}
        if not over:
            break
        want |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    want |= {s: level * weights[s] for s in open_}
    for s in size:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 0.5


def test_reruns_agree_and_order_of_rows_does_not_matter(spark):
    df = small.docs(spark)
    assert small.rows(mixing.mix(df)) == small.rows(mixing.mix(df.repartition(5, "text")))


def test_awkward_rows(spark):
    found = small.rows(mixing.mix(small.crowded(small.docs(spark))))
    assert len(found) == len(small.AWKWARD)
    assert {r[0]: r[1] for r in found if r[0] in (7, 8, 9, 20)} == {7: 0, 8: 0, 9: 0, 20: 30_000}
    assert all(0 <= r[4] <= 2 * r[1] for r in found)


@pytest.mark.parametrize("data", [[], [(1, None, "en", "a", 0), (2, "", "en", None, 0)]])
def test_nothing_to_mix(spark, data):
    found = mixing.mix(small.docs(spark, data)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in found] == [(0, 0, 0.0, 0)] * len(data)
    assert mixing.mixed_documents(small.docs(spark, data)).count() == 0


def test_documents_are_repeated_and_the_last_one_cut(spark):
    data = [(i, f"a{i} b{i} c{i} d{i}", "en", "ab"[i % 2], 15) for i in range(40)]
    df = small.crowded(small.docs(spark, data))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == 15 if len(r.text.split()) == 4 else r.n_chars == len(r.text)
    taken = {r.doc_id: r.taken for r in mixing.mix(df).collect()}
    assert words == {k: v for k, v in taken.items() if v}
