"""Checksums of sets of rows that do not depend on their order, and what differs between two tables by them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What two sets of rows are compared by.
SUMS = ("n", "low", "high")


def key_range(keys: Sequence[str], ranges: int) -> Column:
    """The number of the key range, by a hash of the key, so that ranges are of one size."""
    return F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int").alias("key_range")


def range_sums(rows: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per group: the number of rows and the sums of both halves of their 64-bit hashes.

    Sums of parts add up, so tasks sum their rows before the shuffle, and a group may hold any number of rows
    below 2 ** 31. Rows that repeat count each.
    """
    # The hash passes over NULL, so it also takes in which columns are NULL.
    blanks = [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(columns)]
    h = F.xxhash64(*columns, reduce(add, blanks))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
        F.sum(F.shiftrightunsigned(h, 32)).alias("high"),
    )


def differing(expected: DataFrame, actual: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Groups (``by``) whose rows are not the same in both; a group that one side lacks is among them."""
    sides = [
        range_sums(rows, by, columns).select(*by, F.struct(*SUMS).alias(name))
        for rows, name in ((expected, "wanted"), (actual, "found"))
    ]
    both = sides[0].join(sides[1], list(by), "full")
    return both.where(~F.col("wanted").eqNullSafe(F.col("found"))).select(*by)
