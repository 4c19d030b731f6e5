"""The loads as SQL scripts, and what the catalog's tables accept."""

from __future__ import annotations

import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F

from barhouse.plans.scripts import checked_insert, create_tables, gold_script, run_script, silver_script

BARS = "ticker string, date string, open_price string, high_price string, low_price string, close_price string, volume string"


@pytest.fixture
def prefix(spark):
    name = f"t{uuid.uuid4().hex[:8]}"
    create_tables(spark, name)
    create_tables(spark, name)  # a second time changes nothing
    spark.sql(f"insert into {name}_dim select 1, 'A', 'A Inc', 's', 'i', 'NYSE', 'USD', 'USA' union all "
              "select 2, 'B', 'B Inc', 's', 'i', 'NYSE', 'USD', 'USA'")
    yield name
    for t in spark.catalog.listTables():
        if t.name.startswith(name):
            spark.sql(f"drop {'view' if t.isTemporary else 'table'} {t.name}")


def bronze(spark, prefix, data):
    """Rows of (ticker, date, close, load number)."""
    full = [(t, d, "1", "9", "1", c, "5", n) for t, d, c, n in data]
    df = spark.createDataFrame(full, BARS + ", n int")
    df = df.select("*", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n")).alias("loaded_at"), F.lit("").alias("file_stamp"),
                   F.lit("").alias("source_file"), F.lit(0).alias("file_pos"))
    df.createOrReplaceTempView(f"{prefix}_bronze")
    return f"{prefix}_bronze"


def state(spark, prefix):
    return rows(spark.table(f"{prefix}_fact").select("ticker_id", F.col("date").cast("string"), F.col("close_price").cast("int")))


def marks(spark, prefix):
    return spark.sql(f"select procedure_name, max(high_mark) as m from {prefix}_load_log group by 1 order by 1").collect()


def log(spark, prefix):
    return [tuple(r) for r in spark.sql(f"select procedure_name, outcome, row_count from {prefix}_run_log order by at").collect()]


def test_two_deliveries(spark, prefix):
    first = [("A", "2024-01-02", "10", 1), ("B", "2024-02-02", "20", 1), ("C", "2024-01-02", "30", 1), ("A", "2024-03-01", "x", 1)]
    source = bronze(spark, prefix, first)
    run_script(spark, silver_script(prefix, source))
    run_script(spark, gold_script(prefix))
    assert state(spark, prefix) == [(1, "2024-01-02", 10), (1, "2024-03-01", None), (2, "2024-02-02", 20)]
    files = {f for f in spark.table(f"{prefix}_fact").inputFiles() if "period=2024-02" in f}
    bronze(spark, prefix, [*first, ("A", "2024-01-02", "11", 2), ("B", "2024-01-05", "12", 2)])
    run_script(spark, silver_script(prefix, source))
    run_script(spark, gold_script(prefix))
    found = {(r.ticker_id, str(r.date)): r.close_price and int(r.close_price) for r in spark.table(f"{prefix}_fact").collect()}
    assert found == {(1, "2024-01-02"): 11, (1, "2024-03-01"): None, (2, "2024-02-02"): 20, (2, "2024-01-05"): 12}
    # A period that nothing came for is not written again.
    assert {f for f in spark.table(f"{prefix}_fact").inputFiles() if "period=2024-02" in f} == files
    assert log(spark, prefix) == [
        ("load_silver", "succeeded", 4), ("load_gold", "succeeded", 3), ("load_silver", "succeeded", 2), ("load_gold", "succeeded", 2),
    ]
    before = marks(spark, prefix)
    run_script(spark, silver_script(prefix, source))
    run_script(spark, gold_script(prefix))
    assert marks(spark, prefix) == before


def test_a_failing_script_leaves_the_mark(spark, prefix):
    source = bronze(spark, prefix, [("A", "2024-01-02", "10", 1)])
    run_script(spark, silver_script(prefix, source))
    before, bars = marks(spark, prefix), spark.table(f"{prefix}_silver").count()
    bronze(spark, prefix, [("A", "2024-01-02", "10", 1), ("A", "2024-99-02", "10", 2), ("A", "2024-01-03", "7", 2)])
    run_script(spark, silver_script(prefix, source))
    assert marks(spark, prefix) == before and spark.table(f"{prefix}_silver").count() == bars
    assert log(spark, prefix)[-1] == ("load_silver", "failed", 0)
    run_script(spark, silver_script(prefix, source, quarantine=True))
    assert marks(spark, prefix) != before and spark.table(f"{prefix}_silver").count() == bars + 1
    assert [r.date for r in spark.table(f"{prefix}_rejects").collect()] == ["2024-99-02"]


def test_inserts(spark, prefix):
    dim = f"{prefix}_dim"
    columns = ["ticker_id", "ticker", "company_name", "currency"]
    required = columns[:3]
    checked_insert(spark, dim, columns, "select 3 as ticker_id, 'C' as ticker, 'C Inc' as company_name, 'USD' as currency", required)
    for query, reason in (
        ("select 4 as ticker_id, 'D' as ticker, 'D Inc' as company_name, 'DOLLAR' as currency", "EXCEED_LIMIT_LENGTH"),
        ("select 4 as ticker_id, 'D' as ticker, cast(null as string) as company_name, 'USD' as currency", "NULL in a required"),
        ("select 4 as ticker_id, 'D' as ticker, 'D Inc' as company_name, 'USD' as currency from range(2)", "repeated key"),
    ):
        with pytest.raises(Exception, match=reason):
            checked_insert(spark, dim, columns, query, required)
    assert spark.table(dim).count() == 3
    spark.sql(f"insert into {prefix}_silver (ticker, date, period) values ('A', date'2024-01-02', '2024-01')")
    assert spark.table(f"{prefix}_silver").where("loaded_at is null").isEmpty()
