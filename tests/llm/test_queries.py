"""The registered queries on small tables, against brute force; and the pipeline as a whole."""

from __future__ import annotations

import hashlib
import struct
from collections import defaultdict

import numpy as np
import pytest
import xxhash

import __spark_entry__ as contract
import corpus_pipeline
from barhouse.llm import html_text, mixing, packing, quality
from tests.llm import (
    small,
    test_exact_dedup,
    test_line_dedup,
    test_packing,
    test_pii,
    test_resampling,
    test_simhash,
    test_suffix_dedup,
)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The awkward rows and some given ones as a folder of tables."""
    folder = str(tmp_path_factory.mktemp("tables"))
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()]
    data = [*small.AWKWARD, *[(r[0] + 1000, *r[1:]) for r in given if len(r[1]) < 4000]]
    small.crowded(small.docs(spark, data)).write.parquet(f"{folder}/documents.parquet")
    marks = [(r[0], 1 - r[0] % 2, 0) for r in data if r[0] is not None and r[0] >= 1000]
    test_resampling.labels(spark, marks).write.parquet(f"{folder}/labels.parquet")
    spark.read.parquet(f"{SF}/pages.parquet").limit(60).write.parquet(f"{folder}/pages.parquet")
    return folder, data


def run(spark, tables, name):
    return small.rows(contract.queries()[name](spark, tables[0]))


def test_op1(spark, tables):
    assert run(spark, tables, "op1_suffix_dedup") == test_suffix_dedup.brute(tables[1])


def test_op2(spark, tables):
    pages = spark.read.parquet(f"{tables[0]}/pages.parquet").collect()
    found = {r[0]: r for r in run(spark, tables, "op2_html_text")}
    assert len(found) == len(pages)
    for p in pages:
        article = p.html[p.html.index("<article>") :].split("</article>")[0]
        want = [" ".join(html_text.html.unescape(b).split()) for b in html_text.re.split(r"<[^>]*>", article)]
        text = found[p.page_id][2]
        assert text.replace("\n", " ") == " ".join(b for b in want if b)
        assert found[p.page_id][1] == p.url and found[p.page_id][3] == len(text)


def test_op3(spark, tables):
    want = []
    for r in tables[1]:
        base = test_pii.brute(r[1] or "")
        text = ",".join(f"{test_pii.pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        want.append((r[0], *[sum(k == i for k, _, _ in base) for i in range(4)], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((r[:6] for r in run(spark, tables, "op3_pii_spans")), key=repr) == sorted(want, key=repr)


def test_op4(spark, tables):
    data = [r for r in tables[1] if r[0] is None or r[0] < 1000 or r[1].count("\n") < 40]
    small.docs(spark, data).write.mode("overwrite").parquet(f"{tables[0]}/lines/documents.parquet")
    found = small.rows(contract.queries()["op4_line_dedup"](spark, f"{tables[0]}/lines"))
    want = test_line_dedup.brute(data, 1)
    assert found == sorted(((*r[:4], hashlib.sha256(r[4].encode()).hexdigest()) for r in want), key=repr)


def test_op5(spark, tables):
    found = contract.queries()["op5_best_fit_packing"](spark, tables[0]).collect()
    used = test_packing.check(found, tables[1], 2048)
    assert used <= -(-sum(r.length for r in found) // 2048) + 1


def test_op6(spark, tables):
    pairs = [(r[0], test_simhash.slow_fingerprint(r[1])) for r in tables[1] if r[0] not in (20, 21)]
    found = [r for r in run(spark, tables, "op6_simhash_dedup") if r[0] not in (20, 21)]
    assert found == test_simhash.brute(pairs)


def test_op7(spark, tables):
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables[0]}/labels.parquet").collect()}
    found = [r for r in run(spark, tables, "op7_quality_resampling") if r[0] is not None and r[0] >= 1000]
    # Every text counts for the raw model, so the brute force takes all rows.
    want = test_resampling.brute(list(enumerate(r[1] for r in tables[1])), {i for i, r in enumerate(tables[1]) if marks.get(r[0]) == 1})
    by_id = {r[0]: want[i] for i, r in enumerate(tables[1])}
    assert all(r[1] == pytest.approx(by_id[r[0]]) for r in found)


# The pipeline by brute force, stage by stage, on what the stage before kept.


def noise(doc_id):
    """Gumbel noise from XXH64 over the id and then the seed, as Spark hashes two columns."""
    h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<i", quality.SEED), h)
    return -np.log(-np.log(((h >> 11) + 0.5) / 2.0**53))


def keep_quality(docs, marks):
    good = {i for i, q in marks.items() if q == 1}
    weight = test_resampling.brute([(d[0], d[1]) for d in docs], good)
    known = [(weight[i], q) for i, q in marks.items() if i in weight]
    best = max(
        (sum(w >= t for w, q in known if q) / len(good) - sum(w >= t for w, q in known if not q) / sum(not q for _, q in known), t)
        for t in sorted(w for w, _ in known)
    )[0]
    cuts = sorted(w for w, _ in known)
    score = lambda t: sum(w >= t for w, q in known if q) / len(good) - sum(w >= t for w, q in known if not q) / sum(not q for _, q in known)
    first = next(i for i, w in enumerate(cuts) if score(w) >= best - 1e-9)
    boundary = cuts[0] if first == 0 else (cuts[first - 1] + cuts[first]) / 2
    k = sum(w >= boundary for w in weight.values())
    keys = {d[0]: weight[d[0]] + noise(d[0]) for d in docs}
    threshold = sorted(keys.values(), reverse=True)[k - 1]
    return [d for d in docs if keys[d[0]] >= threshold - 1e-9]


def mixed(docs):
    words = {d[0]: len(mixing_words(d[1])) for d in docs}
    size = defaultdict(int)
    for d in docs:
        size[d[3]] += words[d[0]]
    weight = dict(zip(sorted(size), [3, 1, 2] * len(size)))
    target, open_ = {}, {s for s in size if size[s]}
    while open_:
        level = (1.5 * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= 2 * size[s]}
        if not over:
            break
        target |= {s: 2.0 * size[s] for s in over}
        open_ -= over
    target |= {s: level * weight[s] for s in open_}
    out = []
    for s in target:
        left = int(target[s] + 0.5)
        turn = sorted((d for d in docs if d[3] == s), key=lambda d: hashlib.md5(f"{mixing.SEED}:{d[0]}".encode()).hexdigest())
        while left:
            for d in turn:
                n = min(left, words[d[0]])
                if n:
                    out.append((d[0], d[1] if n == words[d[0]] else " ".join(mixing_words(d[1])[:n])))
                left -= n
    return out


def mixing_words(text):
    return [w for w in text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ") if w]


def test_pipeline_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = keep_quality(docs, marks)
    assert 0 < len(kept) < len(docs)
    stay = {r[1] for r in test_exact_dedup.brute(kept)}
    kept = [d for d in kept if d[0] in stay]
    groups = test_simhash.brute([(d[0], test_simhash.slow_fingerprint(d[1])) for d in kept])
    stay = {r[2] for r in groups}
    kept = [d for d in kept if d[0] in stay]
    data = mixed(kept)
    found = contract.queries()["pipeline"](spark, SF).collect()
    used = test_packing.check(found, data, packing.LENGTH)
    assert used <= -(-sum(r.length for r in found) // packing.LENGTH) + 2
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables[0])
        assert out.columns == docs.columns
        empty = stage(spark, docs.where("false"), tables[0])
        assert empty.columns == docs.columns and empty.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.where("false"), tables[0]).count() == 0
