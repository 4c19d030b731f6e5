"""The control table: per load, when it last finished and how far it has read.

``last_run`` is the finish time of the last good run. ``high_mark`` is the
newest load stamp that run read; the next run reads rows stamped after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.operators.merge import merge_upsert

# Fixed value: older than any real load stamp.
SEED = "2000-01-01 00:00:00"

_KEY = ["procedure_name"]


def _at_seed(names: DataFrame) -> DataFrame:
    seed = F.lit(SEED).cast("timestamp")
    return names.select(*_KEY, seed.alias("last_run"), seed.alias("high_mark"))


def read_marks(control: DataFrame, names: DataFrame) -> DataFrame:
    """The control row of each name; NULL marks where there is none."""
    return names.select(*_KEY).join(control, _KEY, "left")


def seed_marks(control: DataFrame, names: DataFrame) -> DataFrame:
    """Add a seed row for every name that has none."""
    absent = names.select(*_KEY).join(control, _KEY, "left_anti")
    return control.unionByName(_at_seed(absent))


def advance_marks(control: DataFrame, runs: DataFrame) -> DataFrame:
    """Record good runs. A name without a control row is ignored, and a run that
    read nothing (``high_mark`` NULL) leaves the mark where it was."""
    before = control.select(*_KEY, F.col("high_mark").alias("old_mark"))
    moved = runs.join(before, _KEY).select(
        *_KEY, "last_run", F.coalesce("high_mark", "old_mark").alias("high_mark")
    )
    return merge_upsert(control, moved, _KEY)


def reset_marks(control: DataFrame, names: DataFrame) -> DataFrame:
    """Put existing rows back to the seed, so that the next run reads everything."""
    known = names.select(*_KEY).join(control, _KEY, "left_semi")
    return merge_upsert(control, _at_seed(known), _KEY)
