"""Upserts: newest version per key, merge by key, and what a merge does to each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one side of a join that the driver may be made to gather and hand out.
BROADCAST_ROWS = 100_000


def bounded(side: DataFrame, rows: int) -> DataFrame:
    """One side of a join, which is not broadcast if it has many rows; the join meets by shuffle then.

    Spark takes the size of files for the size of rows. Sorted keys need about a byte a row in a file and 160 in
    what the driver gathers, so millions of them may pass for a small table. Of few rows Spark decides.
    """
    return side.hint("merge") if rows > BROADCAST_ROWS else side


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of every key, by the ``order`` columns.

    An aggregation rather than a ranking window: each task first keeps one row
    per key, so a key that holds a large share of the input does not end up in
    one task.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*df.columns)


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], n_source: int = 0) -> DataFrame:
    """Target after the merge: every source row, plus target rows with no source row.

    ``source`` must hold each key once. It is used twice, so hand in one that is
    written down unless it is cheap to compute, as the loads do. An anti join leaves Spark free to
    broadcast a small source, in which case the target is never shuffled; a full
    outer join could not be broadcast. ``n_source`` tells its rows, where they are known.
    """
    kept = target.join(bounded(source.select(*keys), n_source), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per source row: its key and whether the merge inserts or updates it."""
    existing = target.select(*keys).withColumn("in_target", F.lit(True))
    action = F.when(F.col("in_target"), "UPDATE").otherwise("INSERT")
    return source.select(*keys).join(existing, list(keys), "left").select(
        *keys, action.alias("action_taken")
    )


def count_actions(actions: DataFrame) -> DataFrame:
    """Rows per action. An action that did not occur has no row."""
    return actions.groupBy("action_taken").agg(F.count("action_taken").alias("row_count"))
