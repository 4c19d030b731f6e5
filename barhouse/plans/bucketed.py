"""Tables kept in buckets of their key, so that a merge does not shuffle the target however large the increment is."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def default_buckets(spark: SparkSession) -> int:
    """As many as shuffle partitions: with fewer, Spark would rather shuffle both sides of a join into more."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(rows: DataFrame, table: str, keys: Sequence[str], buckets: int, dealt: bool = False) -> None:
    """Add rows to a catalog table in buckets of the key, sorted by it; the table is made if it is missing.

    ``dealt`` rows are already partitioned like the buckets; others are shuffled once, so that a bucket gets one
    file and not one per task.
    """
    if not dealt:
        rows = rows.repartition(buckets, *keys)
    rows.write.mode("append").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def untouched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target's rows that the source does not replace, partitioned as the target is stored."""
    return target.join(source.select(*keys), list(keys), "left_anti")


def merge_bucketed(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str], merged: str, buckets: int) -> DataFrame:
    """Upsert ``source``, which has each key once and is written down, into a bucketed table; the result is ``merged``.

    Only the source is shuffled, into the target's buckets: what stays is joined and written bucket by bucket,
    and the source is added to the buckets after that.
    """
    target = spark.table(table)
    write_bucketed(untouched(target, source, keys), merged, keys, buckets, dealt=True)
    write_bucketed(source.select(*target.columns), merged, keys, buckets)
    return spark.table(merged)
