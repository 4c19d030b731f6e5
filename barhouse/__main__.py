"""Command line of the jobs: ``python -m barhouse ROOT JOB [options]``, or with spark-submit."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from barhouse.operators import rename_candidates
from barhouse.plans import loads
from barhouse.plans.derived import load_derived
from barhouse.plans.quality import quality_counts
from barhouse.plans.repair import repair
from barhouse.plans.scratch import materialise
from barhouse.plans.warehouse import Warehouse
from barhouse.schemas import REBUILDABLE
from barhouse.sources import read_responses
from barhouse.streaming import stream_bronze, stream_silver

log = logging.getLogger("barhouse")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="barhouse")
    parser.add_argument("root", help="folder of the warehouse, shared by all executors")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("create", help="create missing tables and control rows")
    land = jobs.add_parser("land", help="land saved price responses as raw documents")
    land.add_argument("src")
    land.add_argument("landing")
    bronze = jobs.add_parser("bronze", help="load staged files")
    bronze.add_argument("src")
    bronze.add_argument("--glob", default="*.json")
    bronze.add_argument("--stream", metavar="CHECKPOINT", help="load as a stream")
    bronze.add_argument("--archive", metavar="FOLDER", help="with --stream: move files that were read")
    bronze.add_argument("--retries", type=int, default=3, help="passes over rejected files")
    jobs.add_parser("failed", help="name the files that are not loaded")
    jobs.add_parser("verify", help="name the key rules that the tables break")
    jobs.add_parser("compact", help="merge small parts and drop old versions of bars")
    jobs.add_parser("clean", help="remove folders that nothing points to; no load may be running")
    publish = jobs.add_parser("publish", help="put the tables into the session catalog")
    publish.add_argument("--prefix", default="")
    silver = jobs.add_parser("silver", help="load the typed table, then check its quality")
    silver.add_argument("--on-bad-key", choices=["fail", "quarantine"], default="fail")
    silver.add_argument("--on-duplicate-key", choices=["fail", "latest"], default="fail")
    jobs.add_parser("quality", help="report suspicious rows")
    dim = jobs.add_parser("dim", help="load saved company responses into the dimension")
    dim.add_argument("src")
    jobs.add_parser("gold", help="load the fact table")
    jobs.add_parser("backfill", help="add facts whose ticker became known later")
    jobs.add_parser("derived", help="bring the stored figures up to date")
    jobs.add_parser("counts", help="count suspicious rows, reading new parts only")
    typed = jobs.add_parser("silver-stream", help="merge staged files into the typed table as a stream")
    typed.add_argument("src")
    typed.add_argument("checkpoint")
    typed.add_argument("--glob", default="*.json")
    jobs.add_parser("repair", help="load ranges again that differ from the layer below")
    jobs.add_parser("renames", help="name new tickers that may be old ones under a new name")
    rebuild = jobs.add_parser("rebuild", help="empty a table and reset its control row")
    rebuild.add_argument("table", choices=sorted(REBUILDABLE))
    return parser


def _report_load(load: loads.LoadResult) -> None:
    changed = {r.action_taken: r.row_count for r in load.actions.collect()}
    log.info("changed: %s", changed or "nothing")
    if load.detail:
        log.info("%s", load.detail)
    log.info("duration: %s seconds", load.seconds)


def _report_quality(quality: loads.QualityResult) -> None:
    for name, count in quality.counts.items():
        log.info("%s: %s, all rows in %s/report=%s", name, count, quality.path, name)


def _report_failed(wh: Warehouse) -> int:
    """Name every file that is not loaded."""
    failed = 0
    for row in loads.failed_files(wh).toLocalIterator():
        failed += 1
        log.warning("not loaded: %s (%s, tried %s times)", row.source_file, row.reason, row.attempts)
    return failed


def _report_run(run: loads.RunResult) -> int:
    if run.error:
        log.error("%s", run.error)
        return 1
    _report_load(run.load)
    if run.warning:
        log.warning("%s", run.warning)
        for row in run.load.missing_rows.toLocalIterator():
            log.warning("not in the dimension: %s", row.ticker)
    if run.quality:
        _report_quality(run.quality)
    return 0


def run(spark: SparkSession, argv: list[str]) -> int:
    args = _parser().parse_args(argv)
    wh = Warehouse(spark, args.root).create()
    if args.job == "silver":
        options = {"on_bad_key": args.on_bad_key, "on_duplicate_key": args.on_duplicate_key}
        return _report_run(loads.run_silver(wh, **options))
    if args.job == "gold":
        return _report_run(loads.run_gold(wh))
    if args.job == "land":
        outcomes = loads.land_prices(wh, read_responses(spark, args.src), args.landing)
        for r in outcomes.groupBy("outcome", "retryable").count().collect():
            log.info("%s: %s%s", r.outcome, r["count"], " (retry)" if r.retryable else "")
    elif args.job == "bronze" and args.stream:
        stream_bronze(wh, args.src, args.stream, args.glob, archive=args.archive).awaitTermination()
        wh.refresh()
        loads.retry_rejected(wh, args.src, args.glob, args.retries)
        _report_failed(wh)
    elif args.job == "bronze":
        _report_load(loads.load_bronze(wh, args.src, args.glob))
        loads.retry_rejected(wh, args.src, args.glob, args.retries)
        _report_failed(wh)
    elif args.job == "failed":
        _report_failed(wh)
    elif args.job == "verify":
        broken = [name for name, rows in loads.verify_keys(wh).items() if not rows.isEmpty()]
        log.info("broken rules: %s", ", ".join(broken) or "none")
        return int(bool(broken))
    elif args.job == "compact":
        _report_load(loads.compact_bronze(wh))
    elif args.job == "clean":
        log.info("folders removed: %s", wh.drop_superseded())
    elif args.job == "publish":
        wh.publish(args.prefix)
    elif args.job == "dim":
        _report_load(loads.load_dim(wh, read_responses(spark, args.src)))
    elif args.job == "backfill":
        _report_load(loads.backfill_unmatched(wh))
    elif args.job == "quality":
        _report_quality(loads.check_data_quality(wh))
    elif args.job == "derived":
        _report_load(load_derived(wh))
    elif args.job == "counts":
        for name, count in quality_counts(wh).items():
            log.info("%s: %s", name, count)
    elif args.job == "silver-stream":
        stream_silver(wh, args.src, args.checkpoint, args.glob).awaitTermination()
    elif args.job == "repair":
        for load in repair(wh):
            _report_load(load)
    elif args.job == "renames":
        found = rename_candidates(wh.table(loads.SILVER), wh.table(loads.DIM), materialise)
        for r in found.orderBy("ticker").toLocalIterator():
            log.info("%s (id %s) may be %s: %s common days, %.0f %% alike", r.ticker, r.ticker_id, r.current_ticker, r.shared_days, 100 * r.agreement)
    elif args.job == "rebuild":
        wh.rebuild(args.table)
    return 0


def main() -> None:
    logging.basicConfig(format="%(levelname)s %(asctime)s %(message)s")
    log.setLevel(logging.INFO)
    spark = SparkSession.builder.appName("barhouse").getOrCreate()
    try:
        code = run(spark, sys.argv[1:])
    finally:
        spark.stop()
    sys.exit(code)


if __name__ == "__main__":
    main()
