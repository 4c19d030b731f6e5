"""Figures computed when they are asked for, never stored.

The windows run over one ticker. A ticker has at most one bar per day, so a
window group is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def change_columns(key: str = "ticker") -> list[Column]:
    """Change of the close against the bar before, absolute and in percent."""
    close = F.col("close_price")
    before = F.lag(close).over(Window.partitionBy(key).orderBy("date"))
    pct = (close - before).cast("double") / F.nullif(before, F.lit(0)).cast("double") * 100
    return [(close - before).alias("change"), pct.alias("pct_change")]


def average_column(days: int, key: str = "ticker") -> Column:
    """Mean close over the last ``days`` bars, the current one included."""
    w = Window.partitionBy(key).orderBy("date").rowsBetween(1 - days, Window.currentRow)
    mean = F.sum("close_price").over(w).cast("double") / F.count("close_price").over(w)
    return mean.alias("moving_average")


def day_over_day(bars: DataFrame, key: str = "ticker") -> DataFrame:
    return bars.select(key, "date", "close_price", *change_columns(key))


def moving_average(bars: DataFrame, days: int, key: str = "ticker") -> DataFrame:
    return bars.select(key, "date", "close_price", average_column(days, key))


def price_range(bars: DataFrame, key: str = "ticker") -> DataFrame:
    spread = F.col("high_price") - F.col("low_price")
    return bars.select(key, "date", spread.alias("price_range"))
