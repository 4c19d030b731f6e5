"""Tables in buckets of their key, and lookups that open only what can match."""

from __future__ import annotations

import uuid

import pytest
from conftest import bar, rows
from pyspark.sql import functions as F

from barhouse.operators import merge_upsert
from barhouse.plans import lookup, warehouse
from barhouse.plans.bucketed import merge_bucketed, untouched, write_bucketed
from barhouse.plans.lookup import key_lookup
from barhouse.plans.loads import SILVER, load_silver
from barhouse.plans.warehouse import at
from barhouse.schemas import BAR_KEYS, FACT_KEYS

SCHEMA = "ticker_id int, date date, close_price decimal(11,4)"


def facts(spark, ids, close):
    return spark.range(ids.start, ids.stop).select(
        F.col("id").cast("int").alias("ticker_id"),
        F.date_add(F.lit("2024-01-02").cast("date"), (F.col("id") % 3).cast("int")).alias("date"),
        F.lit(close).cast("decimal(11,4)").alias("close_price"),
    )


@pytest.fixture
def names(spark):
    name = f"t{uuid.uuid4().hex[:8]}"
    yield name, f"{name}_merged"
    for t in (name, f"{name}_merged"):
        spark.sql(f"drop table if exists {t}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_into_buckets(spark, names):
    target, fresh = facts(spark, range(40), 1), facts(spark, range(30, 55), 2)
    write_bucketed(target, names[0], FACT_KEYS, 8)
    merged = merge_bucketed(spark, names[0], fresh, FACT_KEYS, names[1], 8)
    assert rows(merged) == rows(merge_upsert(target, fresh, FACT_KEYS))
    # The result is bucketed like the target, so the next merge is as cheap.
    assert "Bucketed: true" in plan_of(merged.join(fresh.hint("merge").select(*FACT_KEYS), list(FACT_KEYS), "left_anti"))


def test_the_target_is_not_shuffled(spark, names):
    write_bucketed(facts(spark, range(40), 1), names[0], FACT_KEYS, 8)
    fresh = facts(spark, range(30, 55), 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(untouched(spark.table(names[0]), fresh, FACT_KEYS))
        plain = plan_of(untouched(facts(spark, range(40), 1), fresh, FACT_KEYS))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Bucketed: true" in plan and plain.count("Exchange hashpartitioning") == 2


@pytest.fixture
def many(wh, spark):
    """6000 tickers of twenty days in small row groups."""
    bars = spark.range(120_000).select(
        F.format_string("T%05d", F.col("id") % 6000).alias("ticker"),
        F.date_add(F.lit("2024-01-02").cast("date"), (F.col("id") / 6000).cast("int")).alias("date"),
        *[F.lit(1).cast("decimal(11,4)").alias(f"{c}_price") for c in ("open", "high", "low", "close")],
        F.col("id").cast("int").alias("volume"),
        at(1).alias("loaded_at"),
    )
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "65536")
    hadoop.set("parquet.block.size.row.check.min", "100")
    try:
        wh.commit(wh.write_periods(SILVER, bars, "many", 1, BAR_KEYS))
    finally:
        hadoop.unset("parquet.block.size")
        hadoop.unset("parquet.block.size.row.check.min")
    return wh


def rows_read(df):
    """What the scans of an executed query gave out."""
    plan = df._jdf.queryExecution().executedPlan()
    if "Adaptive" in plan.nodeName():
        plan = plan.finalPhysicalPlan()
    leaves = plan.collectLeaves()
    found = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        while "QueryStage" in leaf.nodeName():
            leaf = leaf.plan().collectLeaves().apply(0)
        if "Scan parquet" in leaf.nodeName():
            found += leaf.metrics().get("numOutputRows").get().value()
    return found


def test_few_keys_read_few_row_groups(many, spark):
    keys = spark.createDataFrame([("T00017",), ("T00017",), ("T03000",), ("NOBODY",), (None,)], "ticker string")
    found = key_lookup(many, SILVER, keys)
    assert len(found.collect()) == 40
    assert rows_read(found) < 12_000
    whole = many.table(SILVER).where(F.substring("ticker", 2, 9) == "00017")
    assert len(whole.collect()) == 20 and rows_read(whole) == 120_000


def test_more_keys_than_one_list_and_than_the_limit(many, spark, monkeypatch):
    keys = spark.createDataFrame([(f"T{i:05d}",) for i in range(0, 600, 20)], "ticker string")
    found = key_lookup(many, SILVER, keys)
    assert found.count() == 30 * 20
    want = rows(found, "ticker", "date")
    monkeypatch.setattr(lookup, "MOST_PUSHED", 5)
    assert rows(key_lookup(many, SILVER, keys), "ticker", "date") == want


def test_days_open_only_their_periods(many, spark, monkeypatch):
    keys = spark.sql("select 'T00005' as ticker, date'2024-01-03' as date union all select 'T00006', date'2025-01-01'")
    assert rows(key_lookup(many, SILVER, keys), "ticker") == [("T00005",)]
    assert key_lookup(many, SILVER, keys.where("false")).count() == 0


def test_a_large_period_is_dealt_out_over_tasks(wh, add_bronze, spark, monkeypatch):
    monkeypatch.setattr(warehouse, "ROWS_PER_TASK", 100, raising=False)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        tickers = [f"T{i:03d}" for i in range(300)]
        add_bronze([bar(t, d) for t in tickers for d in ("2024-01-02", "2024-01-03")] + [bar(t, "2024-03-01") for t in tickers[:50]])
        load_silver(wh)
        add_bronze([bar(t, "2024-01-03", c="10") for t in tickers[::2]] + [bar("NEW", "2024-01-03")])
        result = load_silver(wh)
    finally:
        spark.conf.unset(setting)
    assert (result.inserted, result.updated) == (1, 150)
    assert {p.name: p.rows for p in wh.parts(SILVER)} == {"2024-01": 601, "2024-03": 50}
    closes = rows(wh.table(SILVER).where("date = date'2024-01-03' and ticker <> 'NEW'"), "ticker", "close_price")
    assert [int(c) for _, c in closes] == [10, 11] * 150
    places = wh.table(SILVER).select("ticker", F.date_format("date", "yyyy-MM").alias("period"), "_metadata.file_path")
    files = {r.period: r.n for r in places.groupBy("period").agg(F.count_distinct("file_path").alias("n")).collect()}
    assert files["2024-01"] > 1 and files["2024-03"] == 1
    # Lookups of a key still meet a single file of a period.
    assert places.groupBy("ticker", "period").agg(F.count_distinct("file_path").alias("n")).where("n > 1").isEmpty()
