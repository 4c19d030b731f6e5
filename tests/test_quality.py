"""The reports and the figures computed at query time."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from conftest import rows

from barhouse.operators import (
    cast_failures,
    day_over_day,
    moving_average,
    negative_values,
    price_inversions,
    price_range,
    quality_details,
    report_counts,
    zero_values,
)
from barhouse.schemas import BRONZE, SILVER

D = dt.date(2024, 1, 2)
T = dt.datetime(2024, 1, 3)


def _silver(spark, data):
    full = [
        (t, D, *[None if x is None else Decimal(x) for x in prices], v, T)
        for t, prices, v in data
    ]
    return spark.createDataFrame(full, SILVER)


# open, high, low, close
CASES = [
    ("inverted", (9, 9, 10, 9), 1),
    ("both", (9, -1, 10, 9), 1),
    ("negative", (9, 10, -1, 9), 1),
    ("zero_volume", (9, 10, 8, 9), 0),
    ("zero_and_negative", (0, 10, 8, 9), -1),
    ("null_high", (9, None, 8, 9), 1),
    ("all_null", (None, None, None, None), None),
    ("fine", (9, 10, 8, 9), 1),
]


def test_each_report(spark):
    silver = _silver(spark, CASES)
    assert rows(price_inversions(silver), "ticker") == [("both",), ("inverted",)]
    assert rows(negative_values(silver), "ticker") == [
        ("both",), ("negative",), ("zero_and_negative",),
    ]
    assert rows(zero_values(silver), "ticker") == [("zero_and_negative",), ("zero_volume",)]
    counts = [("negative_value", 3), ("price_inversion", 2), ("zero_value", 2)]
    assert rows(report_counts(silver)) == counts
    # The list of all reports' rows, from one scan, has the same counts.
    assert rows(quality_details(silver).groupBy("report").count()) == counts
    assert price_inversions(silver).columns == ["ticker", "date", "high_price", "low_price"]
    assert negative_values(silver).columns == [
        "ticker", "date", "high_price", "low_price", "close_price", "open_price", "volume",
    ]
    assert price_inversions(silver).count() == 2


def test_counts_are_zero_on_an_empty_table(spark):
    empty = spark.createDataFrame([], SILVER)
    assert [r.row_count for r in report_counts(empty).collect()] == [0, 0, 0]


def test_cast_failures_count_only_present_values(spark):
    data = [
        ("A", "bad", "1", "x", None, "1e3", "1.5", T, "", "", 0),
        ("A", "2024-01-02", "1", "y", "1", "1", "5", T, "", "", 0),
    ]
    out = dict(rows(cast_failures(spark.createDataFrame(data, BRONZE))))
    assert out == {
        "date": 1, "open_price": 0, "high_price": 2, "low_price": 0, "close_price": 1, "volume": 1,
    }


def test_figures_at_query_time(spark):
    closes = [("A", 1, 10), ("A", 2, 0), ("A", 3, 5), ("B", 1, 7)]
    bars = spark.createDataFrame(
        [
            (t, dt.date(2024, 1, d), Decimal(c), Decimal(c + 2), Decimal(c - 1))
            for t, d, c in closes
        ],
        "ticker string, date date, close_price decimal(11,4), high_price decimal(11,4), "
        "low_price decimal(11,4)",
    )
    change = {(r.ticker, r.date.day): (r.change, r.pct_change) for r in day_over_day(bars).collect()}
    assert change == {("A", 1): (None, None), ("A", 2): (-10, -100.0), ("A", 3): (5, None),
                      ("B", 1): (None, None)}
    mean = {(r.ticker, r.date.day): r.moving_average for r in moving_average(bars, 2).collect()}
    assert mean == {("A", 1): 10.0, ("A", 2): 5.0, ("A", 3): 2.5, ("B", 1): 7.0}
    assert {r.price_range for r in price_range(bars).collect()} == {3}
