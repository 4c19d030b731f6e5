"""The jobs: bronze, silver, dimension and fact loads, the quality report and the runners.

Every load takes a :class:`Warehouse`, writes its result into new folders and
commits target, control row and audit row together. A load that fails commits
only an audit row, so the next run starts from the same mark.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.operators.control import advance_marks
from barhouse.operators.dimension import (
    dim_upsert,
    listed,
    missing_facts,
    resolve_ticker,
)
from barhouse.operators.incremental import incremental, typed_source
from barhouse.operators.keys import check_not_null, check_unique
from barhouse.operators.merge import bounded, latest, merge_upsert
from barhouse.operators.quality import (
    CHECKS,
    DETAIL,
    INVERSION,
    INVERSION_DETAIL,
    quality_details,
    report_counts,
)
from barhouse.plans.scratch import drop_path, few_rows, materialise
from barhouse.plans.warehouse import ALL, Part, Warehouse, at, now_micros
from barhouse.schemas import (
    ACTIONS,
    BAR_KEYS,
    DIM_WIDTHS,
    FACT_KEYS,
    RUN_LOG,
    VALUE_COLS,
    VERSION_ORDER,
)
from barhouse.schemas import LOAD_LOG as CONTROL
from barhouse.sources.price_files import (
    bars_and_verdicts,
    file_of,
    list_price_files,
    read_named_files,
    write_raw,
)
from barhouse.sources.responses import (
    classify_response,
    company_problem,
    parse_company,
    unwrap_daily,
    with_document,
)

BRONZE, FILES = "bronze.stocks_prices", "bronze.files"
SILVER, REJECTS = "silver.stocks_prices", "silver.rejects"
DIM, FACT, UNMATCHED = "gold.dim_ticker", "gold.fact_stock_prices", "gold.unmatched_tickers"
RUN_LOG_TABLE = "pipeline.run_log"

# A file that is staged again with the same name is another file.
FILE_KEYS = ["source_file", "modified_at"]

#: Files whose names one read is given.
FILES_PER_BATCH = 100_000

SUCCEEDED, FAILED = "succeeded", "failed"


class LoadError(Exception):
    """The load was refused; target and control row are as they were."""


@dataclass
class LoadResult:
    run_id: str
    actions: DataFrame
    seconds: int
    inserted: int = 0
    updated: int = 0
    detail: str | None = None
    missing: DataFrame | None = None
    n_missing: int = 0
    missing_rows: DataFrame | None = None
    rejected: DataFrame | None = None


@dataclass
class QualityResult:
    """The six result sets: a count and the offending rows per check, and where all of these are kept."""

    counts: dict[str, int]
    rows: dict[str, DataFrame]
    path: str


@dataclass
class RunResult:
    load: LoadResult | None = None
    quality: QualityResult | None = None
    error: str | None = None
    warning: str | None = None


@dataclass
class Run:
    """One execution of a job: what it has produced so far and what to record about it."""

    wh: Warehouse
    job: str
    run_id: str
    started: int
    parts: list[Part] = field(default_factory=list)
    inserted: int = 0
    updated: int = 0
    detail: str | None = None
    files_loaded: int = 0
    files_rejected: int = 0
    last_run: bool = False
    high_mark: int | None = None
    _scratch: list[str] = field(default_factory=list)

    def once(self, df: DataFrame) -> DataFrame:
        """Write an intermediate result down for the time of the run."""
        path = f"{self.wh.root}/_scratch/{uuid.uuid4().hex}"
        self._scratch.append(path)
        return materialise(df, path)

    def clean(self) -> None:
        for path in self._scratch:
            drop_path(self.wh.spark, path)


def _audit_row(run: Run, outcome: str, finished: int, detail: str | None) -> Part:
    row = few_rows(
        run.wh.spark,
        [
            (
                run.run_id,
                run.job,
                at(run.started),
                at(finished),
                outcome,
                run.inserted,
                run.updated,
                detail,
            )
        ],
        RUN_LOG,
    )
    return run.wh.write_small(RUN_LOG_TABLE, run.run_id, row, 1, run.run_id)


def _control_row(run: Run, finished: int) -> Part:
    mark = None if run.high_mark is None else at(run.high_mark)
    move = few_rows(run.wh.spark, [(run.job, at(finished), mark)], CONTROL)
    return run.wh.write_control(advance_marks(run.wh.control(), move), run.run_id)


@contextmanager
def recorded_run(wh: Warehouse, job: str) -> Iterator[Run]:
    """Run a load; commit everything at the end, or only a record of the failure."""
    wh.refresh()
    run = Run(wh, job, f"{job}-{uuid.uuid4().hex}", now_micros())
    try:
        yield run
        finished = now_micros()
        if run.last_run:
            run.parts.append(_control_row(run, finished))
        run.parts.append(_audit_row(run, SUCCEEDED, finished, run.detail))
        wh.commit(run.parts)
    except Exception as e:
        run.inserted = run.updated = 0
        wh.refresh()
        try:
            wh.commit([_audit_row(run, FAILED, now_micros(), f"{type(e).__name__}: {e}")])
        except Exception as e2:
            e.add_note(f"The failure could not be recorded: {type(e2).__name__}: {e2}")
        raise
    finally:
        run.clean()


def load_result(run: Run) -> LoadResult:
    counts = [("INSERT", run.inserted), ("UPDATE", run.updated)]
    actions = few_rows(run.wh.spark, [c for c in counts if c[1]], ACTIONS)
    seconds = (now_micros() - run.started) // 1_000_000
    return LoadResult(run.run_id, actions, seconds, run.inserted, run.updated, run.detail)


def _hold(name: str, keys, source: DataFrame) -> None:
    """Refuse rows that break the key rules of a table, before they are used."""
    for rule, broken in (("NULL in", check_not_null(source, keys)), ("repeated", check_unique(source, keys))):
        found = broken.first()
        if found is not None:
            raise LoadError(f"{name}: {rule} key, such as {found.asDict()}")


def merge_parts(run: Run, name: str, source: DataFrame, n_source: dict[str, int], keys, stamp: int) -> None:
    """Merge ``source``, which has each key once and no NULL in it, into the periods it touches and count what happened.

    ``n_source`` has its rows per period. The counts need no further join: rows before and after are
    known per period, and every source row ends up in the table exactly once.
    """
    wh = run.wh
    before = wh.parts(name, n_source)
    merged = merge_upsert(wh.read(name, before), source, keys, sum(n_source.values()))
    # No period can have more rows than it had and gets; corrections of what is there make it fewer.
    most = Counter(n_source) + Counter({p.name: p.rows for p in before})
    written = wh.write_periods(name, merged, run.run_id, stamp, tuple(keys), most)
    run.inserted = sum(p.rows for p in written) - sum(p.rows for p in before)
    run.updated = sum(n_source.values()) - run.inserted
    run.parts += written


# -- bronze -----------------------------------------------------------------


def land_prices(wh: Warehouse, responses: DataFrame, landing: str) -> DataFrame:
    """Land the usable price responses (``symbol, body, run_ts``), one document per symbol and run.

    Returns what became of each response; the retryable ones are worth another
    request.
    """
    judged = classify_response(responses, "prices")
    with recorded_run(wh, "land_prices") as run:
        write_raw(unwrap_daily(judged.where("outcome = 'ok'")), landing)
        # At most one row per outcome of the rule table.
        counts = judged.groupBy("outcome").count().orderBy("outcome").collect()
        run.detail = ", ".join(f"{r.outcome}: {r['count']}" for r in counts)
    return judged.select("symbol", "run_ts", "outcome", "retryable")


def loaded_documents(wh: Warehouse) -> DataFrame:
    return wh.table(FILES).where("status = 'loaded'").select(*FILE_KEYS).distinct()


def _open_files(wh: Warehouse, src: str, glob: str) -> DataFrame:
    """Staged files with a document that is not loaded, by name only: nothing is opened.

    A file is known by its address and time. ``begun`` marks those of which other
    documents are loaded.
    """
    documents = wh.table(FILES).groupBy(*FILE_KEYS).agg(
        F.bool_or(F.col("status") == "loaded").alias("loaded")
    )
    known = documents.groupBy(file_of("source_file").alias("file"), "modified_at").agg(
        F.bool_and("loaded").alias("done"), F.bool_or("loaded").alias("begun")
    )
    staged = list_price_files(wh.spark, src, glob).join(known, ["file", "modified_at"], "left")
    return staged.where(~F.coalesce("done", F.lit(False))).select(
        "path", F.coalesce("begun", F.lit(False)).alias("begun")
    )


def append_files(run: Run, files: DataFrame, part: str, folder: str | None = None) -> None:
    """Parse ``files`` and add their bars and verdicts as one new batch, in one pass.

    The input splits decide the size of the written files; :func:`compact_bronze`
    merges them later.
    """
    wh = run.wh
    stamp = wh.next_stamp(BRONZE)
    path = wh.folder(BRONZE, folder or run.run_id)
    rows = bars_and_verdicts(files).withColumn("loaded_at", at(stamp))
    rows.write.partitionBy("kind").parquet(path)
    written = wh.spark.read.schema("status string, kind string").parquet(path)
    counts = {
        (r.kind, r.status): r["count"] for r in written.groupBy("kind", "status").count().collect()
    }
    bars = counts.get(("bar", "loaded"), 0)
    good, bad = counts.get(("file", "loaded"), 0), counts.get(("file", "rejected"), 0)
    run.inserted += bars
    run.files_loaded += good
    run.files_rejected += bad
    run.detail = f"files loaded: {run.files_loaded}, rejected: {run.files_rejected}"
    if bars:
        run.parts.append(Part(BRONZE, part, f"{path}/kind=bar", stamp, bars))
    if good + bad:
        run.parts.append(Part(FILES, part, f"{path}/kind=file", stamp, good + bad))


def load_bronze(wh: Warehouse, src: str, glob: str = "*.json") -> LoadResult:
    """Load the staged documents that are not loaded yet.

    A bad file is rejected whole; the others load. Every run tries every staged
    file that is not loaded, however often it was rejected; ``rejected`` of the
    result names those of this run. The names of staged files are compared with
    the ledger, and only files that are to be read are opened. Their names are
    written down and dealt out by a hash, about ``FILES_PER_BATCH`` to a read, so the
    driver never holds more of them; all batches become visible together.
    """
    with recorded_run(wh, "load_bronze") as run:
        chosen = run.once(_open_files(wh, src, glob))
        batches = -(-chosen.count() // FILES_PER_BATCH)
        for batch in range(batches):
            mine = chosen.where(F.pmod(F.xxhash64("path"), F.lit(batches)) == batch).collect()
            if not mine:
                continue
            files = read_named_files(wh.spark, [f.path for f in mine])
            # Fresh files need no join, so their content is not shuffled for it.
            if any(f.begun for f in mine):
                files = files.join(loaded_documents(wh), FILE_KEYS, "left_anti")
            name = f"{run.run_id}-{batch}" if batch else run.run_id
            append_files(run, files, name, name)
    result = load_result(run)
    verdicts = wh.read(FILES, [p for p in run.parts if p.table == FILES])
    result.rejected = verdicts.where("status = 'rejected'").select("source_file", "reason")
    return result


def retry_rejected(wh: Warehouse, src: str, glob: str = "*.json", passes: int = 3) -> DataFrame:
    """Try what is not loaded again, up to ``passes`` times, and return what is still rejected."""
    for _ in range(passes):
        if failed_files(wh).isEmpty():
            break
        load_bronze(wh, src, glob)
    return failed_files(wh)


def failed_files(wh: Warehouse) -> DataFrame:
    """Documents whose newest state is rejected, with the last reason and the number of tries.

    A load takes a document off only if it is newer than the rejection: of the same document than
    its last one, of another file of the same run and symbol than the first one of this state,
    because a rejected file that still lies there is tried by every run.
    """
    last = latest(wh.table(FILES), FILE_KEYS, ["loaded_at"]).where("status = 'rejected'")
    since = wh.table(FILES).groupBy(*FILE_KEYS).agg(F.min("loaded_at").alias("since"))
    newest = latest(last.join(since, FILE_KEYS), ["source_file"], ["loaded_at", "modified_at"]).alias("r")
    loaded = (
        wh.table(FILES)
        .where("status = 'loaded'")
        .groupBy("source_file", "symbol", "file_stamp")
        .agg(F.max(F.struct("loaded_at", "modified_at")).alias("newest"))
        .alias("l")
    )
    mended = F.expr("l.source_file = r.source_file and l.newest > struct(r.loaded_at, r.modified_at)")
    # A run that was landed again has new files for the same symbols.
    landed_again = F.expr(
        "l.symbol = r.symbol and l.file_stamp = r.file_stamp and l.source_file <> r.source_file"
        " and l.newest > struct(r.since as loaded_at, r.modified_at)"
    )
    tries = wh.table(FILES).groupBy("source_file").agg(F.count("*").alias("attempts"))
    return (
        newest.join(loaded, mended, "left_anti")
        .join(loaded, landed_again, "left_anti")
        .join(tries, "source_file")
        .select("source_file", "reason", "attempts")
    )


def merged_into(parts: list[Part], one: Part) -> list[Part]:
    """Log rows by which ``one`` takes the place of ``parts``."""
    return [one, *[Part(p.table, p.name, one.path, p.stamp, 0) for p in parts]]


def compact_bronze(wh: Warehouse) -> LoadResult:
    """Merge the parts of Bronze, its ledger and the audit log that are one per run.

    Of Bronze only parts that the typed table has read are taken, and of them the
    newest version of each key: older ones can never count again. The other two
    keep all rows.
    """
    with recorded_run(wh, "compact_bronze") as run:
        closed = [p for p in wh.parts(BRONZE) if p.rows and p.stamp <= wh.mark("load_silver")]
        if len(closed) > 1:
            stamp = max(p.stamp for p in closed)
            newest = latest(wh.read(BRONZE, closed), BAR_KEYS, VERSION_ORDER)
            one = wh.write_part(BRONZE, run.run_id, newest, run.run_id, stamp)
            run.parts += merged_into(closed, one)
            run.detail = f"versions dropped: {sum(p.rows for p in closed) - one.rows}"
        for name in (FILES, RUN_LOG_TABLE):
            small = [p for p in wh.parts(name) if p.rows]
            if len(small) > 1:
                merged = f"{run.run_id}-merged"
                one = wh.write_part(name, merged, wh.read(name, small), merged, max(p.stamp for p in small))
                run.parts += merged_into(small, one)
    return load_result(run)


def bronze_current(wh: Warehouse) -> DataFrame:
    """The raw table as an upsert would have left it: the newest version of each key."""
    return latest(wh.table(BRONZE), BAR_KEYS, VERSION_ORDER)


# -- silver -----------------------------------------------------------------


def load_silver(
    wh: Warehouse, on_bad_key: str = "fail", on_duplicate_key: str = "fail"
) -> LoadResult:
    """Cast the raw rows stamped since the last run and merge them into the typed table.

    ``on_bad_key``: ``fail`` refuses the load when a date cannot be read,
    ``quarantine`` sets those rows aside in ``silver.rejects``.
    ``on_duplicate_key``: ``fail`` refuses raw keys that become the same typed
    key, ``latest`` keeps the newest.
    """
    with recorded_run(wh, "load_silver") as run:
        mark = wh.mark(run.job)
        run.last_run = True
        scope = incremental(wh.read(BRONZE, wh.parts(BRONZE, after=mark)), at(mark))
        source = run.once(typed_source(scope, VERSION_ORDER))
        # One row per period of the increment.
        periods = source.groupBy(wh.period_of()).agg(
            F.count("*").alias("n"),
            F.count_if("collides").alias("n_collide"),
            F.count_if(F.col("ticker").isNull()).alias("n_nameless"),
            F.unix_micros(F.max("source_loaded_at")).alias("newest"),
        ).collect()
        bad = sum(p.n for p in periods if p.period is None)
        if bad and on_bad_key == "fail":
            unread = latest(scope.where(F.col("date").try_cast("date").isNull()), BAR_KEYS, VERSION_ORDER)
            raise LoadError(f"{unread.count()} keys have a date that cannot be read")
        good = [p for p in periods if p.period is not None]
        # The increment has each key once, as it is grouped by it.
        nameless = sum(p.n_nameless for p in good)
        if nameless:
            raise LoadError(f"{SILVER}: NULL in key, in {nameless} rows without a ticker")
        collide = sum(p.n_collide for p in good)
        if collide and on_duplicate_key == "fail":
            raise LoadError(f"{collide} keys are written in more than one way")
        if bad:
            rejected = scope.where(F.col("date").try_cast("date").isNull())
            newest = latest(rejected, BAR_KEYS, VERSION_ORDER)
            run.parts.append(
                wh.write_part(
                    REJECTS,
                    run.run_id,
                    newest.withColumn("run_id", F.lit(run.run_id)),
                    run.run_id,
                    now_micros(),
                )
            )
            run.detail = f"quarantined: {run.parts[-1].rows}"
        if periods:
            run.high_mark = max(p.newest for p in periods)
        if good:
            stamp = wh.next_stamp(SILVER)
            bars = source.where("date is not null").select(
                *BAR_KEYS, *VALUE_COLS, at(stamp).alias("loaded_at")
            )
            merge_parts(run, SILVER, bars, {p.period: p.n for p in good}, BAR_KEYS, stamp)
    return load_result(run)


def check_data_quality(wh: Warehouse) -> QualityResult:
    """Count and list suspicious rows of the typed table. Changes nothing in it.

    The table is scanned once. All offending rows are written below
    ``reports/quality``, a folder per run and report; counts and lists come from there.
    """
    path = f"{wh.root}/reports/quality/{uuid.uuid4().hex}"
    flagged = quality_details(wh.table(SILVER))
    flagged.write.partitionBy("report").parquet(path)
    written = wh.spark.read.schema(flagged.schema).parquet(path)
    found = {r.report: r["count"] for r in written.groupBy("report").count().collect()}
    rows = {
        name: written.where(F.col("report") == name).select(
            *(INVERSION_DETAIL if name == INVERSION else DETAIL)
        )
        for name in CHECKS
    }
    return QualityResult({name: found.get(name, 0) for name in CHECKS}, rows, path)


# -- gold -------------------------------------------------------------------


def _merge_fact(run: Run, source: DataFrame) -> None:
    wh = run.wh
    # The typed rows have each key once, so the facts do if the dimension has each ticker once.
    _hold(DIM, ["ticker"], wh.table(DIM))
    resolved = run.once(source)
    periods = resolved.groupBy(wh.period_of()).count().collect()
    if periods:
        n = {p.period: p["count"] for p in periods}
        merge_parts(run, FACT, resolved, n, FACT_KEYS, wh.next_stamp(FACT))


def load_gold(wh: Warehouse) -> LoadResult:
    """Merge the typed rows stamped since the last run into the fact table.

    Rows whose ticker is not in the dimension are left out; their tickers are
    recorded first, in ``gold.unmatched_tickers``. ``missing`` lists them in one
    row, NULL when there are none. Only periods written since the last run are read.
    """
    with recorded_run(wh, "load_gold") as run:
        mark = wh.mark(run.job)
        run.last_run = True
        fresh = wh.parts(SILVER, after=mark)
        scope = incremental(wh.read(SILVER, fresh), at(mark))
        dim, n_dim = wh.table(DIM), wh.row_count(DIM)
        known = bounded(dim.select("ticker"), n_dim)
        left_out = scope.select("ticker", wh.period_of()).distinct().join(known, "ticker", "left_anti")
        left_out = left_out.withColumn("run_id", F.lit(run.run_id))
        unmatched = wh.write_part(UNMATCHED, run.run_id, left_out, run.run_id, now_micros())
        tickers = wh.read(UNMATCHED, [unmatched]).select("ticker").distinct()
        n_missing = tickers.count() if unmatched.rows else 0
        if unmatched.rows:
            run.parts.append(unmatched)
            run.detail = f"tickers not in the dimension: {n_missing}"
        if fresh:
            run.high_mark = max(p.stamp for p in fresh)
        # Either side may be broadcast here, so the smaller one counts.
        _merge_fact(run, resolve_ticker(scope, bounded(dim, min(n_dim, sum(p.rows for p in fresh)))))
    result = load_result(run)
    result.missing, result.n_missing, result.missing_rows = listed(tickers), n_missing, tickers
    return result


def backfill_unmatched(wh: Warehouse) -> LoadResult:
    """Add the fact rows of tickers that were left out earlier and have a dimension row now.

    Only the periods recorded for these tickers are read. What is resolved leaves
    the record in the same commit; when nothing is, nothing is read.
    """
    with recorded_run(wh, "backfill_unmatched") as run:
        dim, record = wh.table(DIM), wh.parts(UNMATCHED)
        open_ = wh.read(UNMATCHED, record).select("ticker", "period").distinct()
        late = run.once(open_.join(bounded(dim.select("ticker"), wh.row_count(DIM)), "ticker", "left_semi"))
        n_late = {r.period: r["count"] for r in late.groupBy("period").count().collect()}
        if n_late:
            periods = list(n_late)
            tickers = run.once(late.select("ticker").distinct())
            n_tickers = tickers.count()
            known = dim.join(bounded(tickers, n_tickers), "ticker", "left_semi")
            n_bars, n_facts = (sum(p.rows for p in wh.parts(name, periods)) for name in (SILVER, FACT))
            known, facts = bounded(known, min(n_tickers, n_bars)), bounded(wh.table(FACT, periods), n_facts)
            _merge_fact(run, missing_facts(wh.table(SILVER, periods), known, facts))
            late = bounded(late, sum(n_late.values()))
            left = open_.join(late, ["ticker", "period"], "left_anti").withColumn("run_id", F.lit(run.run_id))
            one = wh.write_part(UNMATCHED, run.run_id, left, run.run_id, now_micros())
            run.parts += merged_into(record, one)
    return load_result(run)


def load_dim(wh: Warehouse, responses: DataFrame) -> LoadResult:
    """Upsert the dimension from company responses (``symbol, body, received_at``).

    Responses that are no company document, or an incomplete or over-long one,
    are left out and counted in the audit row; the others load. Of several
    responses for one ticker the last received wins. Responses are small but dear to parse, so
    they are dealt out by a hash first: files of few bytes would leave them all to one task. Each is parsed once.
    """
    with recorded_run(wh, "load_dim") as run:
        dealt = with_document(responses.repartition(F.xxhash64("symbol", "body")))
        judged = company_problem(classify_response(dealt, "company"))
        usable = F.col("problem").isNull() & (F.col("outcome") == "ok")
        judged = run.once(judged.withColumn("usable", usable).drop("body"))
        companies = parse_company(judged.where("usable").select("symbol", "document", "received_at"))
        order = ["received_at", *[c for c in DIM_WIDTHS if c != "ticker"]]
        source = run.once(latest(companies, ["ticker"], order).drop("received_at"))
        dim = wh.table(DIM)
        n_source = source.count()
        after = dim_upsert(dim, source, run.once, n_dim=wh.row_count(DIM), n_source=n_source)
        part = wh.write_part(DIM, ALL, after, run.run_id, now_micros())
        run.inserted = part.rows - wh.row_count(DIM)
        run.updated = n_source - run.inserted
        refused = judged.where("not usable").count()
        run.detail = f"responses left out: {refused}" if refused else None
        run.parts.append(part)
    return load_result(run)


# -- runners ----------------------------------------------------------------


def run_silver(wh: Warehouse, **options) -> RunResult:
    """Load the typed table and, only if that worked, check its quality."""
    try:
        load = load_silver(wh, **options)
    except Exception as e:
        return RunResult(error=f"{type(e).__name__}: {e}")
    try:
        return RunResult(load=load, quality=check_data_quality(wh))
    except Exception as e:
        return RunResult(load=load, error=f"{type(e).__name__}: {e}")


def run_gold(wh: Warehouse) -> RunResult:
    """Load the fact table and warn when tickers had to be left out."""
    try:
        load = load_gold(wh)
    except Exception as e:
        return RunResult(error=f"{type(e).__name__}: {e}")
    return RunResult(load=load, warning=load.detail if load.n_missing else None)


def verify_keys(wh: Warehouse) -> dict[str, DataFrame]:
    """Rows that break a key rule of the warehouse, by rule. All are empty in a sound one."""
    silver, fact, dim = wh.table(SILVER), wh.table(FACT), wh.table(DIM)
    ids = fact.select("ticker_id").distinct()
    return {
        "silver_unique": check_unique(silver, BAR_KEYS),
        "silver_not_null": check_not_null(silver, (*BAR_KEYS, "loaded_at")),
        "fact_unique": check_unique(fact, FACT_KEYS),
        "fact_in_dim": ids.join(dim.select("ticker_id"), "ticker_id", "left_anti"),
        "dim_unique_id": check_unique(dim, ["ticker_id"]),
        "dim_unique_ticker": check_unique(dim, ["ticker"]),
        "dim_not_null": check_not_null(dim, ("ticker_id", "ticker", "company_name")),
    }


__all__ = [
    "LoadError",
    "append_files",
    "backfill_unmatched",
    "bronze_current",
    "check_data_quality",
    "compact_bronze",
    "failed_files",
    "land_prices",
    "load_bronze",
    "load_dim",
    "load_gold",
    "load_silver",
    "recorded_run",
    "retry_rejected",
    "run_gold",
    "run_silver",
    "verify_keys",
]
