"""What the driver gathers and hands out does not grow with the tables, however small their files are."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from barhouse.operators import merge_upsert
from barhouse.plans import given, loads
from barhouse.plans.derived import DERIVED, derived_figures, load_derived
from barhouse.plans.quality import quality_counts
from barhouse.plans.scratch import materialise
from barhouse.plans.warehouse import Warehouse, at

#: Tickers, more than the driver is to be given here; their files are small all the same.
MANY = 2_000


@pytest.fixture
def broadcast(spark):
    """The most rows of any broadcast since the test began."""
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def executions():
        bus.waitUntilEmpty(60_000)
        done = store.executionsList()
        return {e.executionId(): e for e in (done.apply(i) for i in range(done.size()))}

    before = set(executions())

    def most():
        plans = [e.physicalPlanDescription() for n, e in executions().items() if n not in before]
        rows = [n for p in plans for n in re.findall(r"BroadcastQueryStage [^\n]*rowCount=([0-9.E+]+)", p)]
        return max((int(float(n)) for n in rows), default=0)

    return most


def _deliver(wh, close: int) -> None:
    """A bar of every ticker on each of two days."""
    spark, stamp = wh.spark, wh.next_stamp(loads.BRONZE)
    value = {c: "10" for c in ("open_price", "high_price", "low_price", "volume")} | {"close_price": str(close)}
    rows = spark.range(2 * MANY).select(
        F.format_string("U%d", F.col("id") % MANY).alias("ticker"),
        F.when(F.col("id") < MANY, "2024-01-02").otherwise("2024-01-03").alias("date"),
        *[F.lit(v).alias(c) for c, v in value.items()],
        at(stamp).alias("loaded_at"), F.lit("").alias("file_stamp"), F.lit("").alias("source_file"), F.lit(0).alias("file_pos"),
    )
    wh.commit([wh.write_part(loads.BRONZE, str(stamp), rows, str(stamp), stamp)])
    loads.load_silver(wh)


def _companies(spark, n: int):
    text = ("company_name", "sector", "industry", "exchange", "currency", "country")
    known = spark.range(n).select(F.format_string("U%d", "id").alias("ticker"), *[F.lit("USD").alias(c) for c in text])
    return given.company_documents(known).withColumn("received_at", at(0))


def test_many_keys_never_reach_the_driver(spark, tmp_path, broadcast, monkeypatch):
    monkeypatch.setattr("barhouse.operators.merge.BROADCAST_ROWS", MANY - 1, raising=False)
    wh = Warehouse(spark, str(tmp_path / "warehouse"), "day").create()
    loads.load_dim(wh, _companies(spark, 10))
    _deliver(wh, 11)
    loads.load_gold(wh)
    loads.load_dim(wh, _companies(spark, MANY))
    assert loads.backfill_unmatched(wh).inserted == 2 * (MANY - 10)
    for close in (11, 12):
        if close == 12:
            _deliver(wh, close)
        loads.load_gold(wh)
        assert load_derived(wh).detail == f"bars changed: {2 * MANY}, figures computed: {2 * MANY}"
        assert quality_counts(wh) == {"price_inversion": 0, "negative_value": 0, "zero_value": 0}
    assert loads.load_dim(wh, _companies(spark, MANY)).updated == MANY
    assert broadcast() < MANY
    assert wh.row_count(loads.DIM) == MANY
    assert wh.table(loads.FACT).where("close_price = 12").distinct().count() == wh.row_count(loads.FACT) == 2 * MANY
    want = derived_figures(wh.table(loads.SILVER))
    assert wh.row_count(DERIVED) == 2 * MANY and wh.table(DERIVED).exceptAll(want).isEmpty()


def test_a_merge_broadcasts_few_rows_only(spark, tmp_path):
    keys = spark.range(50).selectExpr("id as k", "id as v")
    target, source = (materialise(keys, str(tmp_path / name)) for name in ("target", "source"))

    def plan(n):
        return merge_upsert(target, source, ["k"], n)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(50)
    assert "SortMergeJoin" in plan(1_000_000) and "BroadcastHashJoin" not in plan(1_000_000)
