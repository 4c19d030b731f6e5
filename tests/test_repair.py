"""Only what differs from the layer below is loaded again."""

from __future__ import annotations

import pytest
from conftest import bar, rows
from pyspark.sql import functions as F
from test_loads import company, dims

from barhouse.operators.checksums import differing, range_sums
from barhouse.plans.loads import BRONZE, DIM, FACT, RUN_LOG_TABLE, SILVER, LoadError, backfill_unmatched, load_gold, load_silver
from barhouse.plans.repair import repair, repair_fact, repair_silver
from barhouse.plans.warehouse import Warehouse
from barhouse.schemas import BAR_KEYS, FACT_KEYS, VALUE_COLS

DAYS = [f"2024-01-{d:02d}" for d in range(2, 12)]


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), "day").create()


@pytest.fixture
def full(wh, add_bronze):
    """Ten days of forty tickers, two of which the dimension does not know, and a corrected close."""
    dims(wh, *[company(f"T{i}") for i in range(38)])
    add_bronze([bar(f"T{i}", day, c=str(10 + i)) for i in range(40) for day in DAYS])
    add_bronze([bar("T3", DAYS[4], c="99")])
    load_silver(wh)
    load_gold(wh)
    return wh


def state(wh):
    return rows(wh.table(SILVER), *BAR_KEYS, *VALUE_COLS), rows(wh.table(FACT), *FACT_KEYS, *VALUE_COLS)


def lose(wh, name, day, where):
    kept = wh.table(name, [day]).where(where)
    wh.commit(wh.write_periods(name, kept, f"lost-{day}-{wh.next_stamp(name)}", wh.parts(name, [day])[0].stamp, ("date",)))


def test_nothing_to_do(full):
    before, parts = state(full), full.parts(SILVER) + full.parts(FACT)
    silver, gold, fact = repair(full)
    assert (silver.inserted, silver.detail, fact.detail) == (0, None, None)
    assert state(full) == before and full.parts(SILVER) + full.parts(FACT) == parts


def test_only_damaged_days_are_read_and_written(full, monkeypatch):
    before = state(full)
    old = {(p.table, p.name): p.path for t in (SILVER, FACT) for p in full.parts(t)}
    lose(full, SILVER, DAYS[2], "ticker <> 'T7'")
    lose(full, FACT, DAYS[6], F.col("ticker_id") % 5 != 0)
    read = []
    real = Warehouse.read

    def spy(self, name, parts):
        parts = list(parts)
        read.append((name, {p.name for p in parts}))
        return real(self, name, parts)

    monkeypatch.setattr(Warehouse, "read", spy)
    silver = repair_silver(full)
    # One pass over all days compares, everything after it opens the damaged day only.
    touched = [days for name, days in read if name == SILVER]
    assert touched[0] == set(DAYS) and touched[1:] and all(days == {DAYS[2]} for days in touched[1:])
    load_gold(full)
    read.clear()
    repair_fact(full)
    for name in (SILVER, FACT):
        touched = [days for n, days in read if n == name]
        assert touched[0] == set(DAYS) and touched[1:] and all(days == {DAYS[6]} for days in touched[1:])
    monkeypatch.undo()
    assert state(full) == before
    assert silver.detail == f"ranges loaded again: 1, in periods: {DAYS[2]}"
    now = {(p.table, p.name): p.path for t in (SILVER, FACT) for p in full.parts(t)}
    assert {k for k in old if old[k] != now[k]} == {(SILVER, DAYS[2]), (FACT, DAYS[2]), (FACT, DAYS[6])}


def test_changed_added_and_emptied_rows(full):
    before = state(full)
    spark = full.spark
    day = full.table(SILVER, [DAYS[0]])
    odd = day.withColumn("close_price", F.when(F.col("ticker") == "T5", None).otherwise(F.col("close_price")))
    odd = odd.unionByName(day.where("ticker = 'T6'").withColumn("ticker", F.lit("GHOST")))
    full.commit(full.write_periods(SILVER, odd, "odd", 1, ("ticker",)))
    ghosts = day.withColumn("date", F.lit("2023-12-31").cast("date"))
    full.commit(full.write_periods(SILVER, ghosts, "ghosts", 1, ("ticker",)))
    gone = [p for p in full.parts(SILVER, [DAYS[9]])]
    full.commit([type(p)(p.table, p.name, p.path, p.stamp, 0) for p in gone])
    repair(full)
    assert state(full) == before
    assert spark.read.parquet(*[p.path for p in full.parts(RUN_LOG_TABLE)]).where("outcome <> 'succeeded'").isEmpty()


def test_unread_raw_rows_and_waiting_bars_are_left_alone(full, add_bronze):
    add_bronze([bar("T1", DAYS[0], c="77")])  # not loaded yet
    before = state(full)
    repair(full)
    assert state(full) == before
    dims(full, company("T38"))  # known now, its bars wait for the backfill
    repair(full)
    assert state(full) == before
    lose(full, FACT, DAYS[1], "ticker_id > 3")
    repair(full)
    assert state(full) == before
    backfill_unmatched(full)
    assert len(state(full)[1]) == 39 * len(DAYS)
    load_silver(full)
    with pytest.raises(LoadError, match="wait for load_gold"):
        repair_fact(full)


def test_sums_do_not_depend_on_order_but_on_rows(spark):
    a = spark.createDataFrame([("x", 1, None), ("y", 2, 5), ("y", 2, 5)], "k string, a int, b int")
    assert differing(a, a.orderBy(F.desc("a")).repartition(3), ["k"], ["a", "b"]).isEmpty()
    shifted = spark.createDataFrame([("x", None, 1), ("y", 2, 5)], "k string, a int, b int")
    assert rows(differing(a, shifted, ["k"], ["a", "b"])) == [("x",), ("y",)]
    assert rows(differing(a, a.where("k = 'x'"), ["k"], ["a", "b"])) == [("y",)]
    sums = range_sums(a, [], ["a", "b"]).first()
    parts = range_sums(a, ["k"], ["a", "b"]).agg(F.sum("n"), F.sum("low"), F.sum("high")).first()
    assert tuple(sums) == tuple(parts)


def test_names_in_use(full):
    assert full.row_count(BRONZE) == 401 and full.row_count(DIM) == 38
