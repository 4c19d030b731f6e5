"""Repair after a partial loss: which ranges of a table differ from the layer below, and loading only these again.

Both tables are compared down a tree: first by period, then, in the periods that differ, by ranges of the key.
Ranges that differ are replaced by what the layer below gives; rows that it does not give go with them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.functions import date_or_null
from barhouse.operators.checksums import differing, key_range
from barhouse.operators.dimension import resolve_ticker
from barhouse.operators.incremental import typed_source
from barhouse.plans.loads import (
    BRONZE,
    DIM,
    FACT,
    SILVER,
    UNMATCHED,
    LoadError,
    LoadResult,
    Run,
    load_gold,
    load_result,
    recorded_run,
)
from barhouse.plans.warehouse import Part, Warehouse, at
from barhouse.schemas import BAR_KEYS, FACT_KEYS, VALUE_COLS, VERSION_ORDER

#: Key ranges that a period is cut into where it differs.
RANGES = 256

#: Rows of a layer: of the named periods, or all.
Rows = Callable[[Sequence[str] | None], DataFrame]


def _typed_bronze(wh: Warehouse) -> Rows:
    """What the typed table should hold: the newest version of each key that has been read."""
    mark = at(wh.mark("load_silver"))

    def rows(periods: Sequence[str] | None) -> DataFrame:
        raw = wh.table(BRONZE).where(F.col("loaded_at") <= mark)
        day = date_or_null("date")
        raw = raw.where(day.isNotNull() if periods is None else F.date_format(day, wh.date_pattern).isin(*periods))
        return typed_source(raw, VERSION_ORDER).select(*BAR_KEYS, *VALUE_COLS)

    return rows


def _resolved_silver(wh: Warehouse, open_: DataFrame) -> Rows:
    """What the fact table should hold, apart from what waits for :func:`backfill_unmatched`."""

    def rows(periods: Sequence[str] | None) -> DataFrame:
        bars = wh.table(SILVER, periods).withColumn("period", wh.period_of())
        bars = bars.join(open_.select("ticker", "period"), ["ticker", "period"], "left_anti")
        return resolve_ticker(bars, wh.table(DIM))

    return rows


def damaged_ranges(
    wh: Warehouse, expected: Rows, actual: Rows, keys: Sequence[str], run: Run, ranges: int = RANGES
) -> tuple[DataFrame | None, list[str]]:
    """(period, key_range) that differ, and their periods; None if there are none.

    The first level reads both tables; the second only the periods that differ. The driver holds these periods.
    """
    columns = (*keys, *VALUE_COLS)

    def level(periods: Sequence[str] | None, *more) -> DataFrame:
        by = ["period", *["key_range" for _ in more]]
        sides = [rows(periods).select(*columns, wh.period_of(), *more) for rows in (expected, actual)]
        return run.once(differing(*sides, by, columns))

    periods = sorted(r.period for r in level(None).collect())
    return (level(periods, key_range(keys, ranges)) if periods else None), periods


def _replace(
    run: Run, name: str, expected: Rows, found: DataFrame, periods: list[str], keys: Sequence[str], stamp: int, ranges: int, **added
) -> None:
    """Write the damaged periods again: rows outside of the damaged ranges as they are, the others from below."""
    wh = run.wh
    by = ["period", "key_range"]
    old = wh.parts(name, periods)
    kept = wh.read(name, old).withColumns({"period": wh.period_of(), "key_range": key_range(keys, ranges)})
    fresh = expected(periods).withColumns({"period": wh.period_of(), "key_range": key_range(keys, ranges), **added})
    rows = kept.join(found, by, "left_anti").unionByName(run.once(fresh.join(found, by, "left_semi")))
    sizes = {p.name: p.rows for p in old}
    written = wh.write_periods(name, rows.drop(*by), run.run_id, stamp, tuple(keys), sizes)
    left = {p.name for p in written}
    # A period without any right row is empty from now on.
    emptied = [Part(name, p.name, p.path, stamp, 0) for p in old if p.name not in left]
    run.parts += written + emptied
    run.detail = f"ranges loaded again: {found.count()}, in periods: {', '.join(periods)}"


def repair_silver(wh: Warehouse, ranges: int = RANGES) -> LoadResult:
    """Load the ranges of the typed table again that differ from what Bronze gives.

    What is loaded again gets a new stamp, so the next gold load takes it along. Raw rows that no load has read
    yet are left to the next one. Nothing is written when nothing differs.
    """
    with recorded_run(wh, "repair_silver") as run:
        expected = _typed_bronze(wh)

        def actual(periods: Sequence[str] | None) -> DataFrame:
            return wh.table(SILVER, periods)

        found, periods = damaged_ranges(wh, expected, actual, BAR_KEYS, run, ranges)
        if periods:
            stamp = wh.next_stamp(SILVER)
            _replace(run, SILVER, expected, found, periods, BAR_KEYS, stamp, ranges, loaded_at=at(stamp))
    return load_result(run)


def repair_fact(wh: Warehouse, ranges: int = RANGES) -> LoadResult:
    """Load the ranges of the fact table again that differ from what the typed table gives.

    Refused while typed rows wait for :func:`load_gold`. Bars that are recorded as unmatched stay as they are.
    """
    with recorded_run(wh, "repair_fact") as run:
        if wh.parts(SILVER, after=wh.mark("load_gold")):
            raise LoadError("typed rows wait for load_gold")
        open_ = wh.table(UNMATCHED).select("ticker", "period").distinct()
        open_ = run.once(open_.join(wh.table(DIM).select("ticker", "ticker_id"), "ticker", "left"))
        expected = _resolved_silver(wh, open_)

        def actual(periods: Sequence[str] | None) -> DataFrame:
            facts = wh.table(FACT, periods).withColumn("period", wh.period_of())
            return facts.join(open_.where("ticker_id is not null"), ["ticker_id", "period"], "left_anti")

        found, periods = damaged_ranges(wh, expected, actual, FACT_KEYS, run, ranges)
        if periods:
            # Bars that wait for the backfill are in neither side, so those that are there stay.
            waiting = wh.table(FACT, periods).withColumn("period", wh.period_of()).join(
                open_.where("ticker_id is not null"), ["ticker_id", "period"], "left_semi"
            )
            kept = run.once(waiting.select(*FACT_KEYS, *VALUE_COLS))

            def whole(names: Sequence[str] | None) -> DataFrame:
                return expected(names).unionByName(kept)

            _replace(run, FACT, whole, found, periods, FACT_KEYS, wh.next_stamp(FACT), ranges)
    return load_result(run)


def repair(wh: Warehouse) -> tuple[LoadResult, LoadResult, LoadResult]:
    """Bronze against the typed table, then the gold load, then the typed against the fact table."""
    return repair_silver(wh), load_gold(wh), repair_fact(wh)
