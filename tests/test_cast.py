"""Text to typed values, and the filter for new rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import bar, rows
from pyspark.sql import functions as F

from barhouse.operators import cast_prices, incremental, typed_source
from barhouse.plans.warehouse import at
from barhouse.functions import (
    contains_word,
    date_or_null,
    decimal_or_null,
    file_stamp,
    file_symbol,
    int_or_null,
    run_stamp,
    whole_seconds,
)

RAW = "ticker string, date string, open_price string, high_price string, low_price string, " \
    "close_price string, volume string"


def one(spark, text, cast):
    return spark.createDataFrame([(text,)], "x string").select(cast("x")).first()[0]


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("123.45678", Decimal("123.4568")),
        ("12345678.12", None),
        (" 12 ", Decimal("12.0000")),
        ("-5.00", Decimal("-5.0000")),
        ("1e3", None),
        ("1E3", None),
        ("N/A", None),
        ("", None),
        (None, None),
    ],
)
def test_prices(spark, text, value):
    assert one(spark, text, decimal_or_null) == value


@pytest.mark.parametrize(
    ("text", "value"),
    [(" 12 ", 12), ("1.5", None), ("3000000000", None), ("-7", -7), ("", None), ("x", None)],
)
def test_volume(spark, text, value):
    assert one(spark, text, int_or_null) == value


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("2024-01-02", dt.date(2024, 1, 2)),
        ("2024-1-5", dt.date(2024, 1, 5)),
        ("2024-01-02 10:00:00", dt.date(2024, 1, 2)),
        ("2024-02-30", None),
        ("20240102", None),
        ("not-a-date", None),
        ("", None),
    ],
)
def test_dates(spark, text, value):
    assert one(spark, text, date_or_null) == value


def test_cast_keeps_the_row_and_other_columns(spark):
    raw = spark.createDataFrame([(*bar(" AAA ", o="N/A"), 7)], RAW + ", extra int")
    row = cast_prices(raw).first()
    assert (row.ticker, row.open_price, row.high_price, row.extra) == ("AAA", None, 12, 7)


def test_incremental_is_strict_and_needs_a_mark(spark):
    df = spark.range(1).select(at(1_000_000).alias("loaded_at"))
    assert incremental(df, at(999_999)).count() == 1
    assert incremental(df, at(1_000_000)).count() == 0
    assert incremental(df, None).count() == 0


def test_incremental_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select(at(5).alias("loaded_at"), "id").write.parquet(path)
    plan = incremental(spark.read.parquet(path), at(7))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(loaded_at), GreaterThan(loaded_at," in plan


def test_newest_version_wins_and_clashes_are_marked(spark):
    schema = RAW + ", loaded_at int, n int"
    data = [
        (*bar(c="1"), 1, 0),
        (*bar(c="2"), 3, 0),
        (*bar(c="3"), 2, 9),
        (*bar("BBB", c="4"), 1, 0),
        (*bar(" BBB", c="5"), 1, 1),
        (*bar("CCC", "2024-1-5", c="6"), 1, 0),
        (*bar("CCC", "2024-01-05", c="7"), 2, 0),
    ]
    out = typed_source(spark.createDataFrame(data, schema), ("loaded_at", "n"))
    assert rows(out, "ticker", "close_price", "collides") == [
        ("AAA", 2, False),
        ("BBB", 5, True),
        ("CCC", 7, True),
    ]


def test_text_helpers(spark):
    df = spark.range(1).select(
        F.lit("Upgrade to REMOVE it").alias("msg"),
        F.lit("BRK.B_2024-01-02_03-04-05.json").alias("name"),
        F.lit("note.txt").alias("other"),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("a"),
        F.lit("2024-01-02 03:05:06.9").cast("timestamp").alias("b"),
    )
    row = df.select(
        contains_word("msg", "remove"),
        file_symbol("name"),
        file_stamp("name"),
        file_symbol("other"),
        run_stamp("a"),
        whole_seconds("a", "b"),
    ).first()
    assert tuple(row) == (
        True, "BRK.B", "2024-01-02_03-04-05", None, "2024-01-02_03-04-05", 61
    )
