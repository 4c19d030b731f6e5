"""Raw bars to typed bars, and the filter that limits a load to new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barhouse.functions import date_or_null, decimal_or_null, int_or_null
from barhouse.schemas import BAR_KEYS, PRICE_COLS, VALUE_COLS


def typed_columns() -> list[Column]:
    """The seven bar columns, cast from text; a bad value becomes NULL."""
    return [
        F.trim("ticker").alias("ticker"),
        date_or_null("date").alias("date"),
        *[decimal_or_null(c).alias(c) for c in PRICE_COLS],
        int_or_null("volume").alias("volume"),
    ]


def cast_prices(raw: DataFrame) -> DataFrame:
    """Typed bars. Other columns of ``raw`` (load stamp, provenance) pass through."""
    bar = (*BAR_KEYS, *VALUE_COLS)
    return raw.select(*typed_columns(), *[c for c in raw.columns if c not in bar])


def incremental(df: DataFrame, mark: Column | None, col: str = "loaded_at") -> DataFrame:
    """Rows stamped strictly after ``mark``. Without a mark nothing qualifies."""
    return df.where(F.lit(False) if mark is None else F.col(col) > mark)


def typed_source(scope: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """One typed row per key from raw versions: the newest version wins.

    ``collides`` marks a key that several *different* raw keys turned into, for
    instance ``' A'`` and ``'A'``. Both the choice and the test come from one
    aggregation with map-side combine, so a key with very many versions is
    reduced before the shuffle.
    """
    typed = scope.select(
        *typed_columns(),
        F.struct(*BAR_KEYS).alias("raw_key"),
        F.struct(*order).alias("version"),
    )
    return (
        typed.groupBy(*BAR_KEYS)
        .agg(
            F.max_by(F.struct(*VALUE_COLS), "version").alias("bar"),
            (F.min("raw_key") != F.max("raw_key")).alias("collides"),
            F.max("version.loaded_at").alias("source_loaded_at"),
        )
        .select(*BAR_KEYS, "bar.*", "collides", "source_loaded_at")
    )
