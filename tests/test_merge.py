"""Upsert, actions, keys and surrogate ids, against plain Python where it matters."""

from __future__ import annotations

import random

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barhouse.operators import (
    assign_keys,
    check_fk,
    check_not_null,
    check_unique,
    check_widths,
    count_actions,
    dim_upsert,
    has_missing,
    latest,
    merge_actions,
    merge_upsert,
    missing_tickers,
    new_tickers,
    resolve_ticker,
    unmatched_tickers,
)
from barhouse.plans.scratch import materialise

KV = "k1 string, k2 int, v int"


def test_upsert_takes_source_even_when_null_or_unchanged(spark):
    target = spark.createDataFrame([("a", 1, 10), ("b", 1, 20), ("c", 1, 30)], KV)
    source = spark.createDataFrame([("b", 1, None), ("c", 1, 30), ("d", 2, 40)], KV)
    assert rows(merge_upsert(target, source, ["k1", "k2"])) == [
        ("a", 1, 10), ("b", 1, None), ("c", 1, 30), ("d", 2, 40),
    ]
    actions = merge_actions(target, source, ["k1", "k2"])
    assert rows(actions) == [("b", 1, "UPDATE"), ("c", 1, "UPDATE"), ("d", 2, "INSERT")]
    assert rows(count_actions(actions)) == [("INSERT", 1), ("UPDATE", 2)]
    assert rows(count_actions(actions.where("false"))) == []
    assert rows(count_actions(actions.where("action_taken = 'UPDATE'"))) == [("UPDATE", 2)]


KEYS = st.tuples(st.sampled_from("abc"), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(KEYS, st.none() | st.integers(0, 9)), min_size=1, max_size=4))
def test_upserts_in_batches_equal_a_dictionary(spark, batches):
    state, expected = spark.createDataFrame([], KV), {}
    for batch in batches:
        new = spark.createDataFrame([(*k, v) for k, v in batch.items()], KV)
        state = merge_upsert(state, new, ["k1", "k2"])
        expected |= batch
    assert {(r.k1, r.k2): r.v for r in state.collect()} == expected


def test_latest_breaks_ties_and_takes_a_hot_key_apart(spark):
    """A third of all rows share one key; each task keeps one row of it before the shuffle."""
    hot = spark.range(30_000).select(F.lit("hot").alias("k"), F.col("id").alias("t"))
    rest = spark.range(60_000).select(
        (F.col("id") % 1000).cast("string").alias("k"), F.col("id").alias("t")
    )
    data = hot.unionByName(rest).withColumn("v", F.col("t") * 2)
    out = {r.k: (r.t, r.v) for r in latest(data, ["k"], ["t"]).collect()}
    assert len(out) == 1001
    assert out["hot"] == (29_999, 59_998)
    assert out["7"] == (59_007, 118_014)
    plan = latest(data, ["k"], ["t"])._jdf.queryExecution().toString()
    assert "partial_max_by" in plan


def test_key_rules(spark):
    df = spark.createDataFrame(
        [("a", 1, 1), ("a", 1, 2), ("b", None, 3), (None, 2, 4)], "k1 string, k2 int, v int"
    )
    assert rows(check_unique(df, ["k1", "k2"])) == [("a", 1, 2)]
    assert rows(check_not_null(df, ["k1", "k2"]), "v") == [(3,), (4,)]
    parent = spark.createDataFrame([("a",)], "k1 string")
    assert rows(check_fk(df, parent, "k1")) == [("b",)]
    wide = spark.createDataFrame([("abc", "x"), ("abcd", "xy"), (None, "xyz")], "p string, q string")
    assert rows(check_widths(wide, {"p": 3, "q": 2})) == [("p", "abcd", 4, 3), ("q", "xyz", 3, 2)]


def _names(spark, names):
    return spark.createDataFrame([(n, n.lower()) for n in names], "ticker string, sector string")


def test_ids_are_dense_ordered_and_follow_the_highest(spark):
    rnd = random.Random(3)
    # Most names share a prefix, so buckets by prefix would be lopsided.
    names = [f"U{i}" for i in range(900)] + [f"{chr(65 + i % 20)}{i}" for i in range(100)]
    names = sorted(set(names))
    shuffled = rnd.sample(names, len(names))
    used = spark.sql("select 41 as m")
    out = assign_keys(_names(spark, shuffled).repartition(7), used, materialise)
    expected = sorted(names, key=str.encode)
    assert [r.ticker for r in out.orderBy("ticker_id").collect()] == expected
    assert sorted(r.ticker_id for r in out.collect()) == list(range(42, 42 + len(names)))
    first = assign_keys(_names(spark, ["B", "A"]), spark.sql("select cast(null as int)"), materialise)
    assert rows(first, "ticker_id", "ticker") == [(1, "A"), (2, "B")]


def _dim(spark, data):
    return spark.createDataFrame(data, "ticker_id int, ticker string, sector string")


def test_dim_upsert_keeps_ids(spark):
    dim = _dim(spark, [(1, "A", "x"), (5, "B", "y")])
    out = dim_upsert(dim, _names(spark, ["B", "D", "C"]), materialise)
    assert rows(out) == [(1, "A", "x"), (5, "B", "b"), (6, "C", "c"), (7, "D", "d")]
    assert rows(new_tickers(_names(spark, ["B", "D"]), dim), "ticker") == [("D",)]


def test_tickers_without_a_dimension_row(spark):
    bars = spark.sql(
        "select * from values ('A', 1), ('Z', 1), ('Z', 2), ('Y', 1), (null, 1) as t(ticker, n)"
    )
    dim = _dim(spark, [(1, "A", "x")])
    assert rows(unmatched_tickers(bars, dim)) == [(None,), ("Y",), ("Z",)]
    listing = missing_tickers(bars, dim)
    assert rows(listing) == [("Y,Z",)]
    assert rows(has_missing(listing)) == [(True,)]
    none = missing_tickers(bars.where("ticker = 'A'"), dim)
    assert rows(none) == [(None,)]
    assert rows(has_missing(none)) == [(False,)]


def test_resolve_leaves_unknown_tickers_out(spark):
    bars = spark.sql(
        "select ticker, date '2024-01-02' as date, 1 as open_price, 1 as high_price, "
        "1 as low_price, 1 as close_price, 1 as volume from values ('A'), ('Z') as t(ticker)"
    )
    assert rows(resolve_ticker(bars, _dim(spark, [(9, "A", "x")])), "ticker_id") == [(9,)]
