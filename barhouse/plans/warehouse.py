"""The tables of a warehouse under one root folder, as plain parquet.

Nothing is overwritten in place. A load writes new folders and then appends one
small file to ``pipeline/table_log``; that append makes the new data, the
control row and the audit row visible together, or not at all. A load that dies
earlier leaves folders nobody reads.

A table is a set of named parts (a period of dates, a batch, or all of a small
table). The newest log row of a part says which folder holds it. A commit is
refused when another load has moved a part it replaces.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barhouse.operators.control import reset_marks, seed_marks
from barhouse.operators.merge import latest
from barhouse.plans.scratch import create_file, drop_path, few_rows, folder_names
from barhouse.schemas import LOAD_NAMES, LOADS, PERIODIC, REBUILDABLE, TABLE_LOG, TABLES

SCHEMAS = ("bronze", "silver", "gold", "pipeline")
ALL = "all"
PERIODS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}

#: Rows of a period that one task sorts and writes.
ROWS_PER_TASK = 250_000


class ConcurrentLoad(Exception):
    """Another load has changed what this one was based on; nothing was committed."""


@dataclass(frozen=True)
class Part:
    """One folder of a table. ``stamp`` is its newest load stamp in microseconds."""

    table: str
    name: str | None
    path: str | None
    stamp: int
    rows: int


def now_micros() -> int:
    return time.time_ns() // 1000


def at(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros))


class Warehouse:
    """``period`` (``day``, ``month`` or ``year``) is what a load rewrites at least of
    the typed and the fact table. It is chosen when the warehouse is created: a
    month by default, a day when single days are large or corrections are few.
    """

    def __init__(self, spark: SparkSession, root: str, period: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self._wanted_period = period
        self._state: dict[str, list[Part]] | None = None

    # -- definition ---------------------------------------------------------

    def create(self) -> Warehouse:
        """Create what is missing; existing tables and control rows stay as they are."""
        self.refresh()
        self._snapshot()
        parts = [self._empty(name) for name in TABLES if name not in self._made_with]
        if self.row_count("pipeline.load_log") < len(LOADS):
            parts.append(self.write_control(self.control()))
        if parts:
            self.commit(parts)
        return self

    def rebuild(self, name: str) -> None:
        """Empty a table that can be loaded again, and reset its control row with it."""
        load = REBUILDABLE[name]
        control = reset_marks(self.control(), self._names(load))
        self.commit([self._empty(name), self.write_control(control)])

    def empty(self, *names: str) -> None:
        """Empty tables that have no control row."""
        self.refresh()
        self.commit([self._empty(name) for name in names])

    def _empty(self, name: str) -> Part:
        # The row without a part name says: no earlier part counts. It also keeps
        # how the table was made.
        return Part(name, None, self._definition(name), 0, 0)

    def _definition(self, name: str) -> str:
        by = f" by {self.period}" if name in PERIODIC else ""
        return TABLES[name].simpleString() + by

    def _check_definitions(self) -> None:
        for name, made_with in self._made_with.items():
            if made_with != self._definition(name):
                raise ValueError(f"{name} was created as {made_with}")
        if self._wanted_period not in (None, self.period):
            raise ValueError(f"this warehouse is kept by {self.period}")

    @property
    def period(self) -> str:
        """What the typed and the fact table are divided by."""
        self._snapshot()
        made_with = self._made_with.get(next(iter(REBUILDABLE)))
        if made_with:
            return made_with.rpartition(" by ")[2]
        return self._wanted_period or "month"

    @property
    def date_pattern(self) -> str:
        return PERIODS[self.period]

    def period_of(self, date: str = "date") -> Column:
        return F.date_format(date, self.date_pattern).alias("period")

    # -- the log ------------------------------------------------------------

    @property
    def _log_path(self) -> str:
        return f"{self.root}/pipeline/table_log"

    def refresh(self) -> None:
        """Forget the cached state, so that the next read sees other writers' loads."""
        self._state = None

    def _snapshot(self) -> dict[str, list[Part]]:
        if self._state is not None:
            return self._state
        self._last_seq, self._made_with, state = 0, {}, {}
        try:
            log = self.spark.read.schema(TABLE_LOG).json(self._log_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            self._state = {}
            return self._state
        # One row per part: the periods and loads of the warehouse, never its bars.
        rows = latest(log, ["table_name", "part"], ["seq"]).collect()
        emptied = {r.table_name: r.seq for r in rows if r.part is None}
        for r in rows:
            self._last_seq = max(self._last_seq, r.seq)
            live = state.setdefault(r.table_name, [])
            if r.part is None:
                self._made_with[r.table_name] = r.path
            elif r.seq > emptied.get(r.table_name, 0):
                live.append(Part(r.table_name, r.part, r.path, r.stamp, r.n_rows))
        self._state = state
        self._check_definitions()
        return state

    def _version(self, p: Part) -> object:
        """What a part replaces, as far as this object knows the log."""
        live = {q.name: q.path for q in self._snapshot().get(p.table, [])}
        return live if p.name is None else live.get(p.name)

    def commit(self, parts: Iterable[Part]) -> None:
        """Make the parts current, all at once: the log grows by a single file.

        The file is named by the position in the log that it follows and never
        replaces another, so of two commits on one state the second has to look
        again. It is refused if a part it replaces is not the one that was there
        when this object last read the log, which a load does at its start.
        """
        parts = list(parts)
        based_on = [self._version(p) for p in parts]
        while True:
            self.refresh()
            for p, seen in zip(parts, based_on):
                if self._version(p) != seen:
                    raise ConcurrentLoad(f"{p.table}, part {p.name}")
            seq = max(now_micros(), self._last_seq + 1)
            rows = [
                dict(zip(TABLE_LOG.names, (seq + i, p.table, p.name, p.path, p.stamp, p.rows)))
                for i, p in enumerate(parts)
            ]
            text = "".join(json.dumps(row) + "\n" for row in rows)
            if create_file(self.spark, f"{self._log_path}/after-{self._last_seq:020d}.json", text):
                break
        self.refresh()

    # -- reading ------------------------------------------------------------

    def parts(self, name: str, names: Iterable[str] | None = None, after: int | None = None):
        """Live parts of a table, optionally only some names or those stamped after a mark."""
        wanted = None if names is None else set(names)
        return [
            p
            for p in self._snapshot().get(name, [])
            if (wanted is None or p.name in wanted) and (after is None or p.stamp > after)
        ]

    def read(self, name: str, parts: Iterable[Part]) -> DataFrame:
        """Rows of the given parts only: the other folders are not even listed."""
        paths = [p.path for p in parts if p.rows]
        schema = TABLES[name]
        if not paths:
            return few_rows(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def table(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """A whole table, or only the named parts (such as months) of it."""
        return self.read(name, self.parts(name, parts))

    def row_count(self, name: str) -> int:
        return sum(p.rows for p in self.parts(name))

    # -- writing ------------------------------------------------------------

    def folder(self, name: str, run_id: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}/run={run_id}"

    def write_small(
        self, name: str, part: str, df: DataFrame, rows: int, run_id: str | None = None
    ) -> Part:
        """Write a table part of a few rows (control rows, audit rows)."""
        stamp = now_micros()
        path = self.folder(name, run_id or str(stamp))
        df.select(*TABLES[name].names).coalesce(1).write.parquet(path)
        return Part(name, part, path, stamp, rows)

    def write_control(self, control: DataFrame, run_id: str | None = None) -> Part:
        return self.write_small("pipeline.load_log", ALL, control, len(LOADS), run_id)

    def write_part(self, name: str, part: str, df: DataFrame, run_id: str, stamp: int) -> Part:
        """Write a table part of any size."""
        path = self.folder(name, run_id)
        df.select(*TABLES[name].names).hint("rebalance").write.parquet(path)
        return Part(name, part, path, stamp, self._count(name, path))

    def _count(self, name: str, path: str) -> int:
        return self.spark.read.schema(TABLES[name]).parquet(path).count()

    def _deals(self, sizes: Mapping[str, int], period: Column, key: str) -> Column:
        """The number of the task, among those of its period, that writes a row: by a hash of the key."""
        tasks = {p: -(-n // ROWS_PER_TASK) for p, n in sizes.items() if n > ROWS_PER_TASK}
        if not tasks:
            return F.lit(0).cast("long")
        known = F.create_map(*[F.lit(x) for pair in tasks.items() for x in pair])
        return F.pmod(F.xxhash64(key), F.coalesce(known[period], F.lit(1)).cast("long"))

    def write_periods(
        self,
        name: str,
        df: DataFrame,
        run_id: str,
        stamp: int,
        order: tuple[str, ...],
        sizes: Mapping[str, int] | None = None,
    ) -> list[Part]:
        """Write bars by period of ``date``; one part per period.

        A period of which ``sizes`` tells that it has many rows is dealt out by the first column of ``order``, so
        that its write is as parallel as the period is large and a key is in one file. ``rebalance`` splits what is
        above the advisory size all the same, and small periods share a task. Files are sorted by ``order``, and
        row groups get a bloom filter of its first column, as large as its values need.
        """
        path, key = self.folder(name, run_id), self.period
        (
            df.select(*TABLES[name].names, self.period_of().alias(key))
            .withColumn("deal", self._deals(sizes or {}, F.col(key), order[0]))
            .hint("rebalance", key, "deal")
            .drop("deal")
            .sortWithinPartitions(key, *order)
            .write.option(f"parquet.bloom.filter.enabled#{order[0]}", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy(key)
            .parquet(path)
        )
        schema = T.StructType([*TABLES[name].fields, T.StructField(key, T.StringType())])
        written = self.spark.read.schema(schema).parquet(path)
        return [
            Part(name, r[key], f"{path}/{key}={r[key]}", stamp, r["count"])
            for r in written.groupBy(key).count().collect()
        ]

    def drop_superseded(self) -> int:
        """Remove what no table part points to any more, and shorten the log.

        Takes replaced parts and the folders of loads that never committed. Run
        it when no load is running and no reader uses an older state. Returns
        the number of folders removed.
        """
        self.refresh()
        live = {p.path for parts in self._snapshot().values() for p in parts}
        log = self.spark.read.schema(TABLE_LOG).json(self._log_path)
        named = log.where("part is not null").select("path").distinct().collect()
        dead = {r.path for r in named} - live
        # By table and run only, so that it does not matter how the root is spelled.
        used = {re.search(r"[^/]+/[^/]+/run=[^/]+", path).group() for path in live}
        for name in TABLES:
            home = name.replace(".", "/")
            for run in folder_names(self.spark, f"{self.root}/{home}"):
                if f"{home}/{run}" not in used:
                    folder = f"{self.root}/{home}/{run}"
                    dead = {d for d in dead if not d.startswith(folder + "/")} | {folder}
        for path in [*dead, f"{self.root}/_scratch"]:
            drop_path(self.spark, path)
        self._shorten(log)
        return len(dead)

    def _shorten(self, log: DataFrame) -> None:
        # The newest row of each part goes into one file, then the old files go. In
        # between these rows are there twice, which changes nothing.
        old = [r[0] for r in log.select("_metadata.file_path").distinct().collect()]
        newest = latest(log, ["table_name", "part"], ["seq"])
        # A part that was merged into another one holds nothing.
        newest = newest.where("part is null or n_rows > 0")
        newest.coalesce(1).write.mode("append").json(self._log_path)
        for path in old:
            drop_path(self.spark, path)
        self.refresh()

    # -- control rows -------------------------------------------------------

    def _names(self, *names: str) -> DataFrame:
        return few_rows(self.spark, [(n,) for n in names], LOAD_NAMES)

    def control(self) -> DataFrame:
        """The control table, with a seed row for any load that lacks one."""
        control = self.table("pipeline.load_log")
        if self.row_count("pipeline.load_log") >= len(LOADS):
            return control
        return seed_marks(control, self._names(*LOADS))

    def mark(self, load: str) -> int:
        """How far a load has read, in microseconds."""
        row = self.control().where(F.col("procedure_name") == load)
        return row.select(F.unix_micros("high_mark")).first()[0]

    def next_stamp(self, name: str) -> int:
        """A load stamp later than any the table has, whatever the clock says."""
        return max([now_micros(), *[p.stamp + 1 for p in self.parts(name)]])

    # -- plain SQL ----------------------------------------------------------

    def create_schemas(self, prefix: str = "") -> None:
        for schema in SCHEMAS:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{schema}")

    def publish(self, prefix: str = "") -> None:
        """Put the tables into the session catalog, so that plain SELECTs can use them.

        Periods and batches become partitions at their own locations; publish
        again after a load.
        """
        self.create_schemas(prefix)
        for name, schema in TABLES.items():
            self._publish_table(name, prefix + name, schema)

    def _publish_table(self, name: str, full_name: str, schema) -> None:
        sql = self.spark.sql
        key = self.period if name in PERIODIC else "part"
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        sql(f"DROP TABLE IF EXISTS {full_name}")
        live = [p for p in self.parts(name) if p.rows]
        if len(live) == 1 and live[0].name == ALL:
            sql(f"CREATE TABLE {full_name} ({cols}) USING parquet LOCATION '{live[0].path}'")
            return
        home = f"{self.root}/{name.replace('.', '/')}"
        sql(
            f"CREATE TABLE {full_name} ({cols}, `{key}` string) USING parquet "
            f"PARTITIONED BY (`{key}`) LOCATION '{home}'"
        )
        if live:
            specs = " ".join(
                f"PARTITION (`{key}`='{p.name}') LOCATION '{p.path}'" for p in live
            )
            sql(f"ALTER TABLE {full_name} ADD {specs}")
