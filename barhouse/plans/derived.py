"""Derived figures that are stored and kept current: a corrected bar touches itself and the next bars, no others.

The figures of a bar depend on it and on the ``DAYS`` - 1 bars before it. So a changed bar changes its own
figures and those of as many bars after it; to compute one of these, as many bars before it are needed. Which
periods hold them is told by the number of bars per ticker and period, which is kept beside the figures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barhouse.operators.derived import average_column, change_columns
from barhouse.operators.incremental import incremental
from barhouse.operators.merge import bounded
from barhouse.plans.loads import SILVER, LoadResult, Run, load_result, merge_parts, recorded_run
from barhouse.plans.warehouse import Part, Warehouse, at
from barhouse.schemas import BAR_KEYS

DERIVED, COUNTS = "gold.derived_prices", "gold.bar_counts"
#: Bars of the moving average.
DAYS = 5


def derived_figures(bars: DataFrame, days: int = DAYS) -> DataFrame:
    """(ticker, date, close_price, change, pct_change, moving_average) of every bar."""
    return bars.select(*BAR_KEYS, "close_price", *change_columns(), average_column(days))


def _keep_counts(run: Run, fresh: list[Part]) -> DataFrame:
    """Count the bars per ticker of the fresh periods, and return the counts of all."""
    wh, names = run.wh, {p.name for p in fresh}
    # A period that holds no bars any more is among the fresh ones, with no count.
    counts = wh.read(SILVER, fresh).groupBy("ticker", wh.period_of()).agg(F.count("*").cast("int").alias("bars"))
    path = wh.folder(COUNTS, run.run_id)
    # A part is written by few tasks, not by each: otherwise there are as many files as parts times tasks.
    counts.withColumn("part", F.col("period")).hint("rebalance", "part").write.partitionBy("part").parquet(path)
    written = wh.spark.read.schema("ticker string, period string, bars int, part string").parquet(path)
    found = {r.part: r["count"] for r in written.groupBy("part").count().collect()}
    parts = [Part(COUNTS, p.name, f"{path}/part={p.name}", p.stamp, found.get(p.name, 0)) for p in fresh]
    run.parts += parts
    return wh.read(COUNTS, [p for p in wh.parts(COUNTS) if p.name not in names] + parts)


def needed_periods(counts: DataFrame, changed: DataFrame, reach: int) -> DataFrame:
    """(ticker, period, affected): periods with bars that are, or may be, touched or needed to compute those.

    ``changed`` has the tickers and periods with changed bars, ``reach`` is how many bars a change goes on. A
    period after a changed one may be touched if fewer than ``reach`` bars lie between the two, and a period
    before a touched one is needed if fewer than ``reach`` lie between. Only counts are read.
    """
    known = counts.join(changed.select("ticker").distinct(), "ticker", "left_semi")
    marks = changed.select("ticker", "period", F.lit(True).alias("changed"))
    rows = known.join(marks, ["ticker", "period"], "left")
    by_time = Window.partitionBy("ticker").orderBy("period")
    end = F.sum("bars").over(by_time)
    before = by_time.rowsBetween(Window.unboundedPreceding, -1)
    after = by_time.rowsBetween(1, Window.unboundedFollowing)

    def near(distance: Column) -> Column:
        return F.coalesce(distance < reach, F.lit(False))

    placed = rows.withColumns({"end": end, "start": end - F.col("bars")})
    last_change = F.max(F.when(F.col("changed"), F.col("end"))).over(before)
    touched = F.col("changed").isNotNull() | near(F.col("start") - last_change)
    placed = placed.withColumn("affected", touched)
    next_touched = F.min(F.when(F.col("affected"), F.col("start"))).over(after)
    placed = placed.withColumn("needed", F.col("affected") | near(next_touched - F.col("end")))
    return placed.where("needed").select("ticker", "period", "affected")


def touched_figures(bars: DataFrame, changed: DataFrame, days: int) -> DataFrame:
    """The figures of the changed bars (ticker, date) and of the ``days`` - 1 bars after each; ``bars`` holds what they need."""
    marked = bars.join(changed.select(*BAR_KEYS, F.lit(1).alias("is_changed")), list(BAR_KEYS), "left")
    near = Window.partitionBy("ticker").orderBy("date").rowsBetween(1 - max(days, 2), Window.currentRow)
    figures = marked.select(
        *BAR_KEYS, "close_price", *change_columns(), average_column(days), F.max("is_changed").over(near).alias("touched")
    )
    return figures.where("touched = 1").drop("touched")


def load_derived(wh: Warehouse, days: int = DAYS) -> LoadResult:
    """Bring the derived figures up to date with the typed rows stamped since the last run.

    How far it has read is told by the parts of the counts, which have the stamps of the periods they count.
    ``days`` stays the same for the life of the table; :func:`rebuild_derived` comes first to change that, and
    after a repair that took bars away. Of the typed table only the fresh periods and those that the counts name are opened, of the
    derived one only what is written again.
    """
    with recorded_run(wh, "load_derived") as run:
        mark = max((p.stamp for p in wh.parts(COUNTS)), default=0)
        fresh = wh.parts(SILVER, after=mark)
        if fresh:
            scope = incremental(wh.read(SILVER, fresh), at(mark))
            changed = run.once(scope.select(*BAR_KEYS, wh.period_of()))
            n_changed = changed.count()
            changed = bounded(changed, n_changed)
            counts = _keep_counts(run, fresh)
            reach = max(days, 2) - 1
            needed = run.once(needed_periods(counts, changed.select("ticker", "period").distinct(), reach))
            n_needed = {r.period: r["count"] for r in needed.groupBy("period").count().collect()}
            bars = wh.table(SILVER, sorted(n_needed)).withColumn("period", wh.period_of())
            # By days there are as many of them as bars, in files that are hundreds of times smaller than the rows.
            needed = bounded(needed.select("ticker", "period"), sum(n_needed.values()))
            bars = bars.join(needed, ["ticker", "period"], "left_semi").drop("period")
            source = run.once(touched_figures(bars, changed, days))
            n = {r.period: r["count"] for r in source.groupBy(wh.period_of()).count().collect()}
            run.detail = f"bars changed: {n_changed}, figures computed: {sum(n.values())}"
            merge_parts(run, DERIVED, source, n, BAR_KEYS, wh.next_stamp(DERIVED))
    return load_result(run)


def rebuild_derived(wh: Warehouse, days: int = DAYS) -> LoadResult:
    """Compute all figures anew."""
    wh.empty(DERIVED, COUNTS)
    return load_derived(wh, days)
