from __future__ import annotations

import hashlib
import random

import pytest

from barhouse.llm import line_dedup
from tests.llm import small

SPACE = " \t\n\x0b\x0c\r"


def brute(data, least):
    """Every run of every document against all places before it."""
    docs = sorted({(r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest(), r[1] or "") for r in data})
    lines = {d: [x.strip(SPACE) for x in d[3].split("\n") if x.strip(SPACE)] for d in docs}
    first = {}
    for d in docs:
        for a in range(len(lines[d])):
            for b in range(a + 1, len(lines[d]) + 1):
                run = tuple(lines[d][a:b])
                first[run] = min(first.get(run, (d, a)), (d, a))
    out = []
    for r in data:
        d = (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).digest(), r[1] or "")
        gone = [False] * len(lines[d])
        for a in range(len(gone)):
            for b in range(a + 1, len(gone) + 1):
                run = tuple(lines[d][a:b])
                if sum(map(len, run)) >= least and first[run] < (d, a):
                    gone[a:b] = [True] * (b - a)
        left = iter(gone)
        kept = [x for x in d[3].split("\n") if not x.strip(SPACE) or not next(left)]
        runs = sum(x and not y for x, y in zip(gone, [False, *gone]))
        out.append((r[0], len(gone), sum(gone), runs, "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("least", [1, 12, 40])
def test_equals_brute_force(spark, least):
    rng = random.Random(least)
    words = ["a", "be", "sea", "dear", "eager", "a longer line", ""]
    data = []
    for i in range(90):
        lines = rng.choices(words, k=rng.randint(0, 12))
        if i % 4 == 0 and data:
            old = rng.choice(data)[1].split("\n")
            a = rng.randrange(len(old))
            lines[2:2] = old[a : a + rng.randint(1, 12)]
        if i % 10 == 0 and data:
            lines = rng.choice(data)[1].split("\n")
        lines += [f"own {i}"] * (i % 3 == 0)
        data.append((rng.randrange(500), "\n".join(x + rng.choice(["", " ", "\r"]) for x in lines), "en", "a", 0))
    assert small.rows(line_dedup.drop_repeated_lines(small.docs(spark, data).repartition(3), least)) == brute(data, least)


def test_awkward_rows(spark):
    long = "\n".join(f"line {i % 700} of a long text" for i in range(1500))
    data = [*small.AWKWARD, (40, long, "en", "a", 0), (41, long, "en", "a", 0), (None, "x" * 60, "", "", 0), (50, "x" * 60, "", "", 0)]
    found = {}
    for r in line_dedup.drop_repeated_lines(small.crowded(small.docs(spark, data))).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, found.values())) == len(data)
    assert (found[40][0].n_removed, found[41][0].n_removed) == (800, 1500)
    assert found[50][0].text == "x" * 60 and sorted(r.text for r in found[None])[0] == ""
    assert found[21][0].n_removed == 0 and found[7][0].text == ""
    assert [r.text for r in found[30]] == ["same row twice é\U0001f600"] * 2


def test_empty_table(spark):
    assert line_dedup.drop_repeated_lines(small.docs(spark, [])).collect() == []


def test_rounds_go_on_without_a_floor(spark):
    """Each line of a copied passage of 6 lines begins the longest run of a round that has an earlier copy."""
    passage = [f"line {i}" for i in range(6)]
    data = [(1, "\n".join(["one", *passage, "two"]), "", "", 0), (2, "\n".join(["three", *passage, "four"]), "", "", 0)]
    found = line_dedup.later_copies(small.docs(spark, data)).collect()
    assert [(r.doc_id, sorted(map(tuple, r.runs))) for r in found] == [(2, [(1, 4), (2, 4), (3, 4), (4, 2), (5, 2), (6, 1)])]


def test_one_line_over_and_over(spark):
    data = [(1, "\n".join(["same"] * 300), "", "", 0), (2, "\n".join(["same"] * 40 + ["other"]), "", "", 0)]
    for least in (1, 30):
        assert small.rows(line_dedup.drop_repeated_lines(small.docs(spark, data), least).select("doc_id", "n_removed", "n_runs")) == [
            (1, 299, 1), (2, 40, 1)
        ]
