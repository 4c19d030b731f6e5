"""Quality counts that are kept with the parts of the typed table, so that only new parts are scanned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.operators.quality import CHECKS
from barhouse.plans.loads import SILVER, merged_into, recorded_run
from barhouse.plans.scratch import few_rows
from barhouse.plans.warehouse import Warehouse
from barhouse.schemas import PART_QUALITY

QUALITY = "silver.part_quality"
#: Summaries of so many runs are merged into one.
MERGE_AT = 16


def part_counts(wh: Warehouse) -> dict[tuple[str, str], int]:
    """Rows per live part and report, as far as they were counted. The driver holds the part list anyway."""
    return {(r.path, r.report): r.row_count for r in wh.table(QUALITY).collect()}


def quality_counts(wh: Warehouse) -> dict[str, int]:
    """The row count of each report over the whole typed table.

    A part of a table never changes, so its counts hold for as long as it is live: only parts that no run has
    counted are read, all of them in one scan, and their counts are kept. Counts of parts add up.
    """
    with recorded_run(wh, "check_quality") as run:
        live = [p for p in wh.parts(SILVER) if p.rows]
        known = part_counts(wh)
        open_ = [p for p in live if (p.path, next(iter(CHECKS))) not in known]
        if open_:
            counts = wh.read(SILVER, open_).groupBy(wh.period_of()).agg(
                *[F.count_if(test()).alias(name) for name, test in CHECKS.items()]
            )
            by_period = {r.period: r for r in counts.collect()}
            fresh = {(p.path, name): by_period[p.name][name] for p in open_ for name in CHECKS}
            old = [p for p in wh.parts(QUALITY) if p.rows]
            known |= fresh
            whole = len(old) >= MERGE_AT
            paths = {p.path for p in live}
            kept = {k: n for k, n in known.items() if k[0] in paths} if whole else fresh
            rows = few_rows(wh.spark, [(*k, n) for k, n in sorted(kept.items())], PART_QUALITY)
            one = wh.write_small(QUALITY, run.run_id, rows, len(kept), run.run_id)
            run.parts += merged_into(old, one) if whole else [one]
        run.detail = f"parts read: {len(open_)} of {len(live)}"
        return {name: sum(known[p.path, name] for p in live) for name in CHECKS}


def quality_report(wh: Warehouse) -> DataFrame:
    """The counts as rows (report, row_count)."""
    counts = quality_counts(wh)
    rows = few_rows(wh.spark, [("", *item) for item in counts.items()], PART_QUALITY)
    return rows.select("report", "row_count")


__all__ = ["QUALITY", "part_counts", "quality_counts", "quality_report"]
