"""Key and width rules, and surrogate keys.

The checks return the violations; an empty result means the rule holds.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols``."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.col(c).isNull()
    return df.where(bad)


def check_fk(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Distinct key values of ``df`` without a row in ``parent``."""
    present = df.select(key).where(F.col(key).isNotNull()).distinct()
    return present.join(parent.select(key), key, "left_anti")


def check_widths(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """One row per distinct over-long value: column, value and its length."""
    values = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).alias("value"),
                F.char_length(F.col(c)).alias("n_chars"),
                F.lit(n).alias("max_chars"),
            )
            for c, n in widths.items()
        ]
    )
    too_long = F.filter(values, lambda v: v["n_chars"] > v["max_chars"])
    return df.select(F.inline(too_long)).distinct()


def too_wide(widths: Mapping[str, int]) -> Column:
    """Row-level form of :func:`check_widths`."""
    bad = F.lit(False)
    for c, n in widths.items():
        bad = bad | F.coalesce(F.char_length(F.col(c)) > n, F.lit(False))
    return bad


def assign_keys(
    new: DataFrame,
    max_id: DataFrame,
    materialise: Callable[[DataFrame], DataFrame],
    key: str = "ticker",
    id_col: str = "ticker_id",
) -> DataFrame:
    """Give every row of ``new`` the next free id, in the order of ``key``.

    ``new`` holds each key once; ``max_id`` is one row with the highest id in
    use (or NULL). No task ranks more than one range of keys: rows are
    range-partitioned and numbered inside their partition, and the partition
    sizes give the offsets. ``materialise`` writes the numbered rows down once,
    because range bounds are sampled and must not be drawn a second time.
    """
    numbered = materialise(
        new.repartitionByRange(key)
        .sortWithinPartitions(key)
        .withColumn("range_no", F.spark_partition_id())
        .withColumn("row_no", F.monotonically_increasing_id() % F.lit(1 << 33))
    )
    sizes = numbered.groupBy("range_no").agg((F.max("row_no") + 1).alias("rows"))
    # One row per range partition, so the ordered running sum is small.
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "range_no", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    used = F.coalesce(max_id.scalar(), F.lit(0))
    next_id = used + F.col("offset") + F.col("row_no") + 1
    return numbered.join(F.broadcast(offsets), "range_no").select(
        next_id.cast("int").alias(id_col), *new.columns
    )
