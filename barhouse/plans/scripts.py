"""The typed and the fact load as SQL scripts over catalog tables, for callers that have a SQL session only.

The tables are parquet tables of the session catalog. Text widths (``VARCHAR``) and the load stamp (``DEFAULT``)
are kept by the catalog at every insert. Parquet tables declare NOT NULL but do not check it, so
:func:`checked_insert` does. A load is one script: it reads its mark into a variable, stages the increment,
rewrites the periods that this touches, and adds its mark last. The control table only grows and its newest row
counts, so a script that fails anywhere leaves the mark where it was, and its handler records the failure.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from barhouse.schemas import BAR_KEYS, DIM, DIM_WIDTHS, FACT, FACT_KEYS, PRICE_COLS, SILVER, VALUE_COLS, VERSION_ORDER

_SEED = "timestamp'2000-01-01 00:00:00'"
_WIDTHS = {"ticker": DIM_WIDTHS["ticker"], **DIM_WIDTHS}


def _columns(schema: T.StructType, required: Sequence[str], defaults: dict[str, str]) -> str:
    def column(f: T.StructField) -> str:
        kind = f"varchar({_WIDTHS[f.name]})" if f.name in _WIDTHS else f.dataType.simpleString()
        never = " not null" if f.name in required else ""
        return f"{f.name} {kind}{never}" + (f" default {defaults[f.name]}" if f.name in defaults else "")

    return ", ".join(column(f) for f in schema)


def create_tables(spark: SparkSession, prefix: str) -> None:
    """Create what is missing: the typed, rejected, dimension and fact table, the control rows and the run log."""
    now = {"loaded_at": "current_timestamp()"}
    raw = ", ".join(f"{c} string" for c in (*BAR_KEYS, *VALUE_COLS))
    tables = {
        "silver": f"{_columns(SILVER, BAR_KEYS, now)}, period string) using parquet partitioned by (period",
        "rejects": f"{raw}, loaded_at timestamp",
        "dim": _columns(DIM, ("ticker_id", "ticker", "company_name"), {}),
        "fact": f"{_columns(FACT, FACT_KEYS, {})}, loaded_at timestamp, period string) using parquet partitioned by (period",
        "load_log": "procedure_name string, high_mark timestamp, finished_at timestamp default current_timestamp()",
        "run_log": "procedure_name string, outcome string, row_count bigint, at timestamp default current_timestamp()",
    }
    for name, columns in tables.items():
        using = "" if "partitioned by" in columns else " using parquet"
        spark.sql(f"create table if not exists {prefix}_{name} ({columns}){using}")


def checked_insert(spark: SparkSession, table: str, columns: Sequence[str], query: str, required: Sequence[str]) -> None:
    """Insert the rows of a query, or none of them if one lacks a required value or a key repeats.

    The first of ``columns`` is the key. Longer texts are refused and absent load stamps are filled by the catalog.
    """
    empty = " or ".join(f"{c} is null" for c in required)
    spark.sql(f"""
begin
  declare empty, repeated bigint;
  set (empty, repeated) = (
    select count_if({empty}), count({columns[0]}) - count(distinct {columns[0]}) from ({query}));
  if empty > 0 then
    select raise_error('NULL in a required column');
  end if;
  if repeated > 0 then
    select raise_error('repeated key');
  end if;
  insert into {table} ({", ".join(columns)}) {query};
end""")


def _load(prefix: str, name: str, target: str, keys: Sequence[str], staged: str, check: str, source: str, newest: str) -> str:
    """The script of a load: ``staged`` is its increment, ``source`` what of it is merged, ``check`` what refuses it."""
    columns = ", ".join((*keys, *VALUE_COLS, "loaded_at", "period"))
    stage, log = f"{prefix}_{name}_stage", f"{prefix}_run_log"
    return f"""
begin
  declare mark, newest timestamp;
  declare merged bigint;
  declare exit handler for sqlexception
  begin
    drop table if exists {stage};
    insert into {log} (procedure_name, outcome, row_count) values ('{name}', 'failed', 0);
  end;
  set mark = (select coalesce(max(high_mark), {_SEED}) from {prefix}_load_log where procedure_name = '{name}');
  drop table if exists {stage};
  create table {stage} using parquet as {staged};
  {check}
  set (merged, newest) = (select count(*), {newest} from {stage});
  if merged > 0 then
    insert overwrite {target} ({columns})
      select {columns} from ({source.format(stage=stage)})
      union all
      select {columns} from {target} t left anti join ({source.format(stage=stage)}) s using ({", ".join(keys)})
      where period in (select period from {stage});
    insert into {prefix}_load_log (procedure_name, high_mark) values ('{name}', newest);
  end if;
  drop table if exists {stage};
  insert into {log} (procedure_name, outcome, row_count) values ('{name}', 'succeeded', merged);
end"""


def silver_script(prefix: str, bronze: str, quarantine: bool = False) -> str:
    """Cast the raw rows of ``bronze`` stamped since the mark, newest version per key, and merge them."""
    values = ", ".join([*[f"try_cast({c} as decimal(11,4)) as {c}" for c in PRICE_COLS], "try_cast(volume as int) as volume"])
    version = f"struct({', '.join(VERSION_ORDER)})"
    raw = ", ".join((*BAR_KEYS, *VALUE_COLS, "loaded_at"))
    staged = f"""
    select ticker, date, bar.*, current_timestamp() as loaded_at, date_format(date, 'yyyy-MM') as period, read_at
    from (
      select trim(ticker) as ticker, try_cast(date as date) as date,
        max_by(struct({values}), {version}) as bar, max(loaded_at) as read_at
      from {bronze} where loaded_at > mark group by all)"""
    unread = f"from {bronze} where loaded_at > mark and try_cast(date as date) is null"
    if quarantine:
        check = f"insert into {prefix}_rejects ({raw}) select {raw} {unread};"
    else:
        check = f"""if exists (select 1 {unread}) then
    select raise_error('a date cannot be read');
  end if;"""
    source = "select * from {stage} where date is not null"
    return _load(prefix, "load_silver", f"{prefix}_silver", BAR_KEYS, staged, check, source, "max(read_at)")


def gold_script(prefix: str) -> str:
    """Merge the typed rows stamped since the mark into the fact table, keyed by the dimension."""
    columns = ", ".join((*FACT_KEYS, *VALUE_COLS, "loaded_at", "period"))
    staged = f"""
    select {columns} from {prefix}_silver join (select ticker, ticker_id from {prefix}_dim) using (ticker)
    where loaded_at > mark"""
    source = "select * from {stage}"
    newest = f"(select max(loaded_at) from {prefix}_silver)"
    return _load(prefix, "load_gold", f"{prefix}_fact", FACT_KEYS, staged, "", source, newest)


def run_script(spark: SparkSession, script: str) -> None:
    """Run a load; only the periods that it writes are replaced."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        spark.sql(script)
    finally:
        spark.conf.set(setting, before)
