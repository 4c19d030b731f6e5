"""Resolving tickers through the dimension, and keeping the dimension."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.operators.keys import assign_keys
from barhouse.operators.merge import bounded, merge_upsert
from barhouse.schemas import FACT_KEYS, VALUE_COLS


def resolve_ticker(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Fact rows: bars whose ticker is in the dimension, keyed by its id.

    No hint: Spark broadcasts the dimension when its size allows it, and
    otherwise splits oversized join partitions at run time.
    """
    ids = dim.select("ticker", "ticker_id")
    return bars.join(ids, "ticker").select(*FACT_KEYS, *VALUE_COLS)


def unmatched_tickers(bars: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct tickers without a dimension row. Reduced before the join."""
    return bars.select("ticker").distinct().join(dim.select("ticker"), "ticker", "left_anti")


def listed(tickers: DataFrame, col: str = "ticker") -> DataFrame:
    """All tickers as one comma-separated, ordered text in one row; NULL when there are none.

    The lists of the first characters are sorted and joined in parallel; the
    last step only strings those few texts together. One text cannot hold any
    number of tickers: :func:`unmatched_tickers` gives them as rows.
    """
    lead = F.substring(col, 1, 3).alias("lead")
    parts = tickers.where(F.col(col).isNotNull()).groupBy(lead).agg(
        F.expr(f"listagg({col}, ',') within group (order by {col})").alias("part")
    )
    return parts.agg(
        F.expr("listagg(part, ',') within group (order by lead)").alias("missing_tickers")
    )


def missing_tickers(bars: DataFrame, dim: DataFrame) -> DataFrame:
    return listed(unmatched_tickers(bars, dim))


def has_missing(missing: DataFrame) -> DataFrame:
    """Whether the one-row listing names any ticker."""
    return missing.select(F.col("missing_tickers").isNotNull().alias("has_missing"))


def new_tickers(candidates: DataFrame, dim: DataFrame) -> DataFrame:
    """Candidates the dimension does not know, for a person to check for renames."""
    return candidates.join(dim.select("ticker"), "ticker", "left_anti")


def missing_facts(bars: DataFrame, dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact rows for bars that have a dimension row but are not in the fact table."""
    return resolve_ticker(bars, dim).join(fact.select(*FACT_KEYS), list(FACT_KEYS), "left_anti")


def dim_upsert(
    dim: DataFrame,
    source: DataFrame,
    materialise: Callable[[DataFrame], DataFrame],
    columns: Sequence[str] | None = None,
    n_dim: int = 0,
    n_source: int = 0,
) -> DataFrame:
    """Dimension after an upsert by ticker: known tickers keep their id.

    ``source`` holds each ticker once. It meets the dimension in a single join,
    which is written down; what found no id there gets a new one. ``n_dim`` and ``n_source``
    tell the rows of both, where they are known.
    """
    columns = list(columns or dim.columns)
    met = materialise(source.join(bounded(dim.select("ticker", "ticker_id"), n_dim), "ticker", "left"))
    new = met.where("ticker_id is null").drop("ticker_id")
    added = assign_keys(new, dim.agg(F.max("ticker_id")), materialise)
    changed = met.where("ticker_id is not null").select(*columns).unionByName(added.select(*columns))
    return merge_upsert(dim.select(*columns), changed, ["ticker"], n_source)
