"""Read-only reports on typed bars.

A NULL never trips a check, and a row may be in several reports.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barhouse.functions import date_or_null, decimal_or_null, int_or_null
from barhouse.schemas import PRICE_COLS

# The columns of the reports, in their order.
CHECKED = ("high_price", "low_price", "close_price", "open_price", "volume")
DETAIL = ("ticker", "date", *CHECKED)
INVERSION_DETAIL = ("ticker", "date", "high_price", "low_price")

INVERSION, NEGATIVE, ZERO = "price_inversion", "negative_value", "zero_value"


def is_inverted() -> Column:
    return F.col("high_price") < F.col("low_price")


def is_negative() -> Column:
    return reduce(or_, [F.col(c) < 0 for c in CHECKED])


def is_zero() -> Column:
    return reduce(or_, [F.col(c) == 0 for c in CHECKED])


CHECKS = {INVERSION: is_inverted, NEGATIVE: is_negative, ZERO: is_zero}


def price_inversions(silver: DataFrame) -> DataFrame:
    return silver.where(is_inverted()).select(*INVERSION_DETAIL)


def negative_values(silver: DataFrame) -> DataFrame:
    return silver.where(is_negative()).select(*DETAIL)


def zero_values(silver: DataFrame) -> DataFrame:
    return silver.where(is_zero()).select(*DETAIL)


def quality_details(silver: DataFrame) -> DataFrame:
    """Every report's rows, with the report's name, from one scan."""
    reports = F.array(*[F.when(test(), F.lit(name)) for name, test in CHECKS.items()])
    return silver.select(F.explode(F.array_compact(reports)).alias("report"), *DETAIL)


def report_counts(silver: DataFrame) -> DataFrame:
    """One row per report with its number of rows; all from one scan."""
    counts = silver.agg(*[F.count_if(test()).alias(name) for name, test in CHECKS.items()])
    return as_rows(counts, list(CHECKS), "report", "row_count")


def as_rows(one_row: DataFrame, cols: list[str], name: str, value: str) -> DataFrame:
    """A one-row result turned into one row per column."""
    return one_row.unpivot([], cols, name, value)


def cast_failures(bronze: DataFrame) -> DataFrame:
    """Per column: raw values that are present but cannot be typed."""
    casts = {
        "date": date_or_null("date"),
        **{c: decimal_or_null(c) for c in PRICE_COLS},
        "volume": int_or_null("volume"),
    }
    counts = bronze.agg(
        *[F.count_if(F.col(c).isNotNull() & v.isNull()).alias(c) for c, v in casts.items()]
    )
    return as_rows(counts, list(casts), "column_name", "failures")
