"""Every operator as a query over the given tables, with the same query in SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barhouse import operators as op
from barhouse import sources as src
from barhouse.functions import file_stamp, file_symbol, run_stamp, whole_seconds
from barhouse.plans import given as g
from barhouse.plans import scenario
from barhouse.plans.bucketed import default_buckets, merge_bucketed, write_bucketed
from barhouse.plans.scratch import materialise
from barhouse.schemas import BAR_KEYS, DIM_WIDTHS, FACT_KEYS, PRICE_COLS, VALUE_COLS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

_BAR = ", ".join((*BAR_KEYS, *VALUE_COLS))
_VALUES = ", ".join(VALUE_COLS)
_FACT = ", ".join((*FACT_KEYS, *VALUE_COLS))
_DIM = ", ".join(("ticker_id", *DIM_WIDTHS))


def query(name: str, oracle: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return register


# -- shared inputs ----------------------------------------------------------


def typed(spark, sf):
    """All raw bars, cast."""
    return op.cast_prices(g.raw_bars(spark, sf)).drop("k", "day")


def silver(spark, sf):
    """The increment: raw bars stamped after the mark, cast."""
    raw = op.incremental(g.raw_bars(spark, sf), g.mark())
    return op.cast_prices(raw).drop("k", "day")


def source(spark, sf):
    return silver(spark, sf).where("date is not null")


def target(spark, sf):
    return g.bars(spark, sf).where(F.col("date") < F.lit(g.TARGET_END).cast("date")).drop("k")


# -- cast, filter, quality --------------------------------------------------


@query("silver_cast", g.sql("select * from typed", "typed"))
def silver_cast(spark, sf):
    return typed(spark, sf)


@query(
    "incremental_filter",
    g.sql(
        f"select trim(ticker) as ticker, date, close_price, loaded_at from raw_bars "
        f"where loaded_at > timestamp '{g.MARK}'",
        "raw_bars",
    ),
)
def incremental_filter(spark, sf):
    rows = op.incremental(g.raw_bars(spark, sf), g.mark())
    return rows.select(F.trim("ticker").alias("ticker"), "date", "close_price", "loaded_at")


@query(
    "dq_inversion",
    g.sql(
        "select ticker, date, high_price, low_price from typed where high_price < low_price",
        "typed",
    ),
)
def dq_inversion(spark, sf):
    return op.price_inversions(typed(spark, sf))


_DETAIL = "ticker, date, high_price, low_price, close_price, open_price, volume"


@query(
    "dq_negative",
    g.sql(
        f"select {_DETAIL} from typed where high_price < 0 or low_price < 0 "
        "or close_price < 0 or open_price < 0 or volume < 0",
        "typed",
    ),
)
def dq_negative(spark, sf):
    return op.negative_values(typed(spark, sf))


@query(
    "dq_zero",
    g.sql(
        f"select {_DETAIL} from typed where high_price = 0 or low_price = 0 "
        "or close_price = 0 or open_price = 0 or volume = 0",
        "typed",
    ),
)
def dq_zero(spark, sf):
    return op.zero_values(typed(spark, sf))


_DQ_COUNTS = """
select 'price_inversion' as report, cast(count(*) as bigint) as row_count
from {0} where high_price < low_price
union all
select 'negative_value', cast(count(*) as bigint) from {0}
where high_price < 0 or low_price < 0 or close_price < 0 or open_price < 0 or volume < 0
union all
select 'zero_value', cast(count(*) as bigint) from {0}
where high_price = 0 or low_price = 0 or close_price = 0 or open_price = 0 or volume = 0"""


@query("dq_counts", g.sql(_DQ_COUNTS.format("typed"), "typed"))
def dq_counts(spark, sf):
    return op.report_counts(typed(spark, sf))


@query(
    "cast_failures",
    g.sql(
        """
select 'date' as column_name, cast(count(*) as bigint) as failures
from raw_bars where date is not null and try_cast(date as date) is null
union all select 'open_price', cast(count(*) as bigint) from raw_bars
where open_price is not null and try_cast(open_price as decimal(11,4)) is null
union all select 'high_price', cast(count(*) as bigint) from raw_bars
where high_price is not null and try_cast(high_price as decimal(11,4)) is null
union all select 'low_price', cast(count(*) as bigint) from raw_bars
where low_price is not null and try_cast(low_price as decimal(11,4)) is null
union all select 'close_price', cast(count(*) as bigint) from raw_bars
where close_price is not null and try_cast(close_price as decimal(11,4)) is null
union all select 'volume', cast(count(*) as bigint) from raw_bars
where volume is not null and try_cast(volume as int) is null""",
        "raw_bars",
    ),
)
def cast_failures(spark, sf):
    return op.cast_failures(g.raw_bars(spark, sf))


# -- merge ------------------------------------------------------------------


@query(
    "upsert_state",
    g.sql(
        f"""
select {", ".join(f"coalesce(s.{c}, t.{c}) as {c}" for c in BAR_KEYS)},
  {", ".join(
      f"case when s.ticker is not null then s.{c} else t.{c} end as {c}"
      for c in (*VALUE_COLS, "loaded_at")
  )}
from target t full outer join source s on t.ticker = s.ticker and t.date = s.date""",
        "target",
        "source",
    ),
)
def upsert_state(spark, sf):
    return op.merge_upsert(target(spark, sf), source(spark, sf), BAR_KEYS)


@query(
    "merge_actions",
    g.sql(
        """
select case when t.ticker is null then 'INSERT' else 'UPDATE' end as action_taken,
  cast(count(*) as bigint) as row_count
from source s left join target t on t.ticker = s.ticker and t.date = s.date group by 1""",
        "target",
        "source",
    ),
)
def merge_actions(spark, sf):
    return op.count_actions(op.merge_actions(target(spark, sf), source(spark, sf), BAR_KEYS))


_VERSIONS = """
select ticker, date, close_price, loaded_at, 1 as version from text_bars
union all
select ticker, date, cast(cast(cast(close_price as decimal(11,4)) + 1 as decimal(11,4)) as varchar),
  loaded_at + interval 1 day, 2
from text_bars where open_price < close_price"""


@query(
    "bronze_current",
    g.sql(
        f"""
select ticker, date, close_price, loaded_at, version from (
  select *, row_number() over (partition by ticker, date order by loaded_at desc, version desc) rn
  from ({_VERSIONS}))
where rn = 1""",
        "text_bars",
    ),
)
def bronze_current(spark, sf):
    text = g.text_bars(spark, sf)
    later = text.where("open_price < close_price").select(
        "ticker", "date", _plus_one("close_price"), _day_later("loaded_at"), F.lit(2).alias("version")
    )
    first = text.select("ticker", "date", "close_price", "loaded_at", F.lit(1).alias("version"))
    return op.latest(first.unionByName(later), BAR_KEYS, ["loaded_at", "version"])


def _plus_one(c):
    return (F.col(c).cast("decimal(11,4)") + 1).cast("decimal(11,4)").cast("string").alias(c)


def _day_later(c):
    return (F.col(c) + F.expr("interval 1 day")).alias(c)


_RESPELLED = """
select trim(ticker) as ticker, date, open_price, high_price, low_price, close_price, volume,
  loaded_at - interval 1 day as loaded_at from raw_bars where open_price < close_price
union all
select ticker, date, open_price, high_price, low_price, close_price, volume, loaded_at
from raw_bars"""


@query(
    "newest_typed",
    g.sql(
        f"""
select {_BAR}, collides, source_loaded_at from (
  select trim(ticker) as ticker, try_cast(date as date) as date,
    {", ".join(f"try_cast({c} as decimal(11,4)) as {c}" for c in PRICE_COLS)},
    try_cast(volume as int) as volume, loaded_at as source_loaded_at,
    count(*) over (partition by trim(ticker), try_cast(date as date)) > 1 as collides,
    row_number() over (partition by trim(ticker), try_cast(date as date)
                       order by loaded_at desc) as rn
  from ({_RESPELLED}))
where rn = 1""",
        "raw_bars",
    ),
)
def newest_typed(spark, sf):
    """Two raw spellings of one key: the newer one wins and the clash is marked."""
    raw = g.raw_bars(spark, sf).drop("k", "day")
    older = (
        raw.where("open_price < close_price")
        .withColumn("ticker", F.trim("ticker"))
        .withColumn("loaded_at", F.col("loaded_at") - F.expr("interval 1 day"))
    )
    return op.typed_source(raw.unionByName(older), ("loaded_at",))


# -- gold -------------------------------------------------------------------


@query(
    "gold_resolve",
    g.sql(
        f"select d.ticker_id, s.date, {_VALUES} from typed s join dim d on s.ticker = d.ticker",
        "typed",
        "dim",
    ),
)
def gold_resolve(spark, sf):
    return op.resolve_ticker(typed(spark, sf), g.dim(spark, sf))


_UNMATCHED = """
select distinct ticker from silver s
where not exists (select 1 from dim d where d.ticker = s.ticker)"""


@query("unmatched_tickers", g.sql(_UNMATCHED, "silver", "dim"))
def unmatched_tickers(spark, sf):
    return op.unmatched_tickers(silver(spark, sf), g.dim(spark, sf))


@query(
    "missing_tickers",
    g.sql(
        f"select string_agg(ticker, ',' order by ticker) as missing_tickers from ({_UNMATCHED})",
        "silver",
        "dim",
    ),
)
def missing_tickers(spark, sf):
    return op.missing_tickers(silver(spark, sf), g.dim(spark, sf))


@query(
    "has_missing",
    g.sql(f"select count(ticker) > 0 as has_missing from ({_UNMATCHED})", "silver", "dim"),
)
def has_missing(spark, sf):
    return op.has_missing(missing_tickers(spark, sf))


_RESOLVED = (
    f"select d.ticker_id, x.date, {_VALUES} from {{0}} x join {{1}} d on x.ticker = d.ticker"
)


@query(
    "gold_upsert",
    g.sql(
        f"""
select coalesce(s.ticker_id, t.ticker_id) as ticker_id, coalesce(s.date, t.date) as date,
  {", ".join(
      f"case when s.ticker_id is not null then s.{c} else t.{c} end as {c}" for c in VALUE_COLS
  )}
from ({_RESOLVED.format("target", "dim")}) t
full outer join ({_RESOLVED.format("source", "dim")}) s
  on t.ticker_id = s.ticker_id and t.date = s.date""",
        "target",
        "source",
        "dim",
    ),
)
def gold_upsert(spark, sf):
    dim = g.dim(spark, sf)
    fact = op.resolve_ticker(target(spark, sf), dim)
    return op.merge_upsert(fact, op.resolve_ticker(source(spark, sf), dim), FACT_KEYS)


_BUCKETED: dict[tuple[str, str], str] = {}


@query("gold_upsert_bucketed", ORACLES["gold_upsert"])
def gold_upsert_bucketed(spark, sf):
    """The same merge into a fact table that is kept in buckets of its key."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BUCKETED:
        name, buckets = f"b{uuid.uuid4().hex[:12]}", default_buckets(spark)
        dim = g.dim(spark, sf)
        write_bucketed(op.resolve_ticker(target(spark, sf), dim), name, FACT_KEYS, buckets)
        fresh = materialise(op.resolve_ticker(source(spark, sf), dim))
        merge_bucketed(spark, name, fresh, FACT_KEYS, f"{name}_merged", buckets)
        spark.sql(f"drop table {name}")
        _BUCKETED[key] = f"{name}_merged"
    return spark.table(_BUCKETED[key])


@query(
    "gold_backfill",
    g.sql(
        f"""
select * from ({_RESOLVED.format("typed", "dim")}) s
where not exists (
  select 1 from ({_RESOLVED.format("typed", "known_dim")}) f
  where f.ticker_id = s.ticker_id and f.date = s.date)""",
        "typed",
        "dim",
        "known_dim",
    ),
)
def gold_backfill(spark, sf):
    bars = typed(spark, sf)
    fact = op.resolve_ticker(bars, g.known_dim(spark, sf))
    return op.missing_facts(bars, g.dim(spark, sf), fact)


# -- dimension --------------------------------------------------------------

_NEW = "select * from dim where ticker not in (select ticker from known_dim)"


@query("new_tickers", g.sql(_NEW, "dim", "known_dim"))
def new_tickers(spark, sf):
    return op.new_tickers(g.dim(spark, sf), g.known_dim(spark, sf))


_RENAMES = f"""
, spans as (select ticker, max(date) as last from renamed_bars group by 1),
sides as (
  select s.*, d.ticker is null as is_new, last < (select max(last) from spans) as stopped
  from spans s left join dim d using (ticker)),
indexed as (
  select b.*, last, is_new, stopped from renamed_bars b join sides using (ticker) where is_new or stopped),
rare as (select date, {_VALUES} from indexed group by all having count(*) between 2 and 8),
pairs as (
  select distinct a.ticker, b.ticker as new_ticker, b.last as new_last
  from indexed a join indexed b using (date, {_VALUES}) join rare using (date, {_VALUES})
  where a.stopped and b.is_new and b.last > a.last),
days as (
  select p.*, {" and ".join(f"x.{c} = y.{c}" for c in VALUE_COLS)} as same
  from pairs p join renamed_bars x using (ticker)
    join renamed_bars y on y.ticker = p.new_ticker and y.date = x.date),
good as (
  select ticker, new_ticker, new_last, count(*) as shared_days,
    count(*) filter (same) / cast(count(*) as double) as agreement
  from days group by all having shared_days >= 3 and agreement >= 0.7),
links as (
  select * from good
  qualify row_number() over (partition by ticker order by new_last, agreement desc, new_ticker) = 1),
walk as (
  select ticker, new_ticker as current_ticker, 1 as steps from links
  union all
  select w.ticker, l.new_ticker, steps + 1 from walk w join links l on l.ticker = w.current_ticker),
ends as (select ticker, arg_max(current_ticker, steps) as current_ticker, max(steps) as steps from walk group by 1)
select ticker_id, ticker, new_ticker, shared_days, agreement, current_ticker, cast(steps as int) as steps
from links join dim using (ticker) join ends using (ticker)"""


@query("rename_candidates", g.sql(_RENAMES, "renamed_bars", "dim").replace("with ", "with recursive ", 1))
def rename_candidates(spark, sf):
    return op.rename_candidates(g.renamed_bars(spark, sf), g.dim(spark, sf), materialise)


_NUMBERED = f"""
select cast((select max(ticker_id) from known_dim) + row_number() over (order by ticker) as int)
  as ticker_id, {", ".join(DIM_WIDTHS)} from ({_NEW})"""


@query("surrogate_keys", g.sql(_NUMBERED, "dim", "known_dim"))
def surrogate_keys(spark, sf):
    known = g.known_dim(spark, sf)
    new = op.new_tickers(g.dim(spark, sf), known).drop("ticker_id")
    numbered = op.assign_keys(new, known.agg(F.max("ticker_id")), materialise)
    return numbered.select("ticker_id", *DIM_WIDTHS)


@query(
    "dim_upsert",
    g.sql(
        f"""
select k.ticker_id, k.ticker, k.company_name,
  case when c.ticker is not null then lower(k.sector) else k.sector end as sector,
  k.industry, k.exchange, k.currency, k.country
from known_dim k left join (select ticker from dim where exchange in ('ASIA', 'EUROPE')) c
  on c.ticker = k.ticker
union all
select cast((select max(ticker_id) from known_dim) + row_number() over (order by ticker) as int),
  ticker, company_name, lower(sector), industry, exchange, currency, country
from ({_NEW}) where exchange in ('ASIA', 'EUROPE')""",
        "dim",
        "known_dim",
    ),
)
def dim_upsert(spark, sf):
    """News about the companies of two exchanges: known ones change, new ones get an id."""
    news = (
        g.dim(spark, sf)
        .where(F.col("exchange").isin("ASIA", "EUROPE"))
        .withColumn("sector", F.lower("sector"))
        .drop("ticker_id")
    )
    return op.dim_upsert(g.known_dim(spark, sf), materialise(news), materialise)


# -- key and width rules ----------------------------------------------------


@query(
    "pk_violations",
    "select l_orderkey, l_linenumber, cast(count(*) as bigint) as row_count from lineitem "
    "group by 1, 2 having count(*) > 1",
)
def pk_violations(spark, sf):
    return op.check_unique(g.given(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "fk_violations",
    g.sql(
        "select distinct ticker from bars t "
        "where not exists (select 1 from dim d where d.ticker = t.ticker)",
        "bars",
        "dim",
    ),
)
def fk_violations(spark, sf):
    return op.check_fk(g.bars(spark, sf), g.dim(spark, sf), "ticker")


@query(
    "not_null_violations",
    g.sql("select * from typed where date is null or open_price is null", "typed"),
)
def not_null_violations(spark, sf):
    return op.check_not_null(typed(spark, sf), ["date", "open_price"])


@query(
    "width_violations",
    """
select 'r_name' as column_name, r_name as value, cast(length(r_name) as int) as n_chars,
  10 as max_chars
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
where length(r_name) > 10
group by 2
union all
select 'c_name', c_name, cast(length(c_name) as int), 12 from customer
where length(c_name) > 12 group by 2""",
)
def width_violations(spark, sf):
    rows = (
        g.given(spark, sf, "customer")
        .join(g.given(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(g.given(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return op.check_widths(rows, {"r_name": 10, "c_name": 12})


# -- control table ----------------------------------------------------------

_SEED = "timestamp '2000-01-01 00:00:00'"


def _customers(spark, sf):
    return g.given(spark, sf, "customer").select(g.load_name("c_custkey"))


def _names_in_debt(spark, sf):
    return g.given(spark, sf, "customer").where("c_acctbal < 0").select(g.load_name("c_custkey"))


@query(
    "watermark_read",
    g.sql(
        "select procedure_name, last_run, high_mark "
        "from customers left join control using (procedure_name)",
        "customers",
        "control",
    ),
)
def watermark_read(spark, sf):
    return op.read_marks(g.control_rows(spark, sf), _customers(spark, sf))


@query(
    "watermark_seed",
    g.sql(
        f"""
select * from control
union all
select procedure_name, {_SEED}, {_SEED} from customers
where procedure_name not in (select procedure_name from control)""",
        "customers",
        "control",
    ),
)
def watermark_seed(spark, sf):
    return op.seed_marks(g.control_rows(spark, sf), _customers(spark, sf))


@query(
    "watermark_advance",
    g.sql(
        f"""
select procedure_name, coalesce(r.last_run, c.last_run) as last_run,
  coalesce(r.high_mark, c.high_mark) as high_mark
from control c left join (
  select 'load_U' || user_id as procedure_name, max(ts) as last_run,
    max(case when event_type = 'purchase' then ts end) as high_mark
  from events where ts >= timestamp '{g.MARK}' group by 1) r using (procedure_name)""",
        "control",
    ),
)
def watermark_advance(spark, sf):
    """Runs after the mark; those that read no purchase leave the high mark alone."""
    runs = (
        g.events(spark, sf)
        .where(F.col("ts") >= g.mark())
        .groupBy(g.load_name("user_id"))
        .agg(
            F.max("ts").alias("last_run"),
            F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("high_mark"),
        )
    )
    return op.advance_marks(g.control_rows(spark, sf), runs)


@query(
    "watermark_reset",
    g.sql(
        f"""
select procedure_name, case when d.n is null then last_run else {_SEED} end as last_run,
  case when d.n is null then high_mark else {_SEED} end as high_mark
from control left join (
  select 'load_U' || c_custkey as n from customer where c_acctbal < 0) d on d.n = procedure_name""",
        "control",
    ),
)
def watermark_reset(spark, sf):
    return op.reset_marks(g.control_rows(spark, sf), _names_in_debt(spark, sf))


@query(
    "run_seconds",
    """
select 'load_U' || user_id as procedure_name,
  cast(date_sub('second', min(ts), max(ts)) as bigint) as seconds
from events group by 1""",
)
def run_seconds(spark, sf):
    runs = g.events(spark, sf).groupBy(g.load_name("user_id")).agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at")
    )
    return runs.select("procedure_name", whole_seconds("started_at", "finished_at").alias("seconds"))


# -- documents and responses ------------------------------------------------

_TEXT = f"select {_BAR} from text_bars"


@query("ingest_json", g.sql(_TEXT, "text_bars"))
def ingest_json(spark, sf):
    docs = g.price_documents(g.text_bars(spark, sf))
    return src.flatten_prices(docs, "body").select(*BAR_KEYS, *VALUE_COLS)


def _faulty_documents(spark, sf):
    """Documents in which some bars lack a field and some hold an over-long one."""
    text = g.text_bars(spark, sf)
    high = F.when(~g.every(31), F.col("high_price"))
    volume = F.when(g.every(53), F.lpad("volume", 13, "0")).otherwise(F.col("volume"))
    return g.price_documents(text.withColumn("high_price", high).withColumn("volume", volume))


_FAULTY = "select ticker from text_bars where k % 31 = 0 or k % 53 = 0"


@query(
    "ingest_reject",
    g.sql(f"{_TEXT} where ticker not in ({_FAULTY})", "text_bars"),
)
def ingest_reject(spark, sf):
    good, _ = src.split_valid_files(_faulty_documents(spark, sf), "body")
    return good.select(*BAR_KEYS, *VALUE_COLS)


@query(
    "rejected_files",
    g.sql(
        """
select ticker as symbol,
  case when bool_or(k % 31 = 0) then 'missing_field' else 'too_long' end as reason
from text_bars group by 1 having bool_or(k % 31 = 0 or k % 53 = 0)""",
        "text_bars",
    ),
)
def rejected_files(spark, sf):
    _, rejected = src.split_valid_files(_faulty_documents(spark, sf), "body")
    return rejected.select("symbol", "reason")


@query(
    "file_provenance",
    g.sql(
        "select ticker as symbol, strftime(loaded_at, '%Y-%m-%d_%H-%M-%S') as file_stamp "
        "from text_bars",
        "text_bars",
    ),
)
def file_provenance(spark, sf):
    name = F.concat("ticker", F.lit("_"), run_stamp("loaded_at"), F.lit(".json"))
    names = g.text_bars(spark, sf).select(name.alias("name"))
    return names.select(
        file_symbol("name").alias("symbol"), file_stamp("name").alias("file_stamp")
    )


@query(
    "unwrap_daily",
    g.sql(_TEXT, "text_bars"),
)
def unwrap_daily(spark, sf):
    docs = g.price_documents(g.text_bars(spark, sf))
    series = F.expr("get_json_object(body, concat('$.', symbol))")
    envelope = F.concat(
        F.lit('{"Meta Data": {"2. Symbol": "x"}, "Time Series (Daily)": '), series, F.lit("}")
    )
    unwrapped = src.unwrap_daily(docs.withColumn("body", envelope))
    return src.flatten_prices(unwrapped, "body").select(*BAR_KEYS, *VALUE_COLS)


@query("parse_company", g.sql(f"select {', '.join(DIM_WIDTHS)} from companies", "companies"))
def parse_company(spark, sf):
    return src.parse_company(g.company_documents(g.companies(spark, sf))).select(*DIM_WIDTHS)


# Bodies by a number of the row: templates over its own columns, valid SQL for both engines.
_PRICE_BODIES = [
    "props",
    "'{\"Error Message\": \"the API key for ' || event_type || ' is invalid\"}'",
    "'{\"Error Message\": \"unknown Symbol U' || user_id || '\"}'",
    "'{\"Error Message\": \"' || event_type || '\", \"Information\": \"remove\"}'",
    "'{\"Information\": \"Upgrade ' || event_type || ' to REMOVE the daily limit\"}'",
    "'{\"Information\": \"at most 1 request per second, U' || user_id || '\"}'",
    "'{\"Information\": \"' || event_type || '\"}'",
    "'{\"Time Series (Daily)\": ' || props || '}'",
    "'{\"Time Series (Daily)\": ' || props || '}<html>'",
    "substr(props, 1, length(props) - 1)",
    "'[' || props || ']'",
    "cast(null as string)",
    "'{\"Name\": \"' || event_type || '\"}'",
    "'  {\"Time Series (Daily)\": {}}  '",
]
_COMPANY_BODIES = [
    "'{\"Name\": \"' || c_name || '\", \"Sector\": \"' || c_mktsegment || '\"}'",
    "'{\"Time Series (Daily)\": {}}'",
    "'{\"Name\": \"' || c_name || '\"} {}'",
    "'{\"Error Message\": \"' || c_mktsegment || ' api KEY symbol\"}'",
]


def _body(number: str, bodies: list[str]) -> str:
    cases = " ".join(f"when {i} then {b}" for i, b in enumerate(bodies))
    return f"case {number} % {len(bodies)} {cases} end"


_RESPONSES = f"""
select 'E' || event_id as symbol, 'prices' as kind, {_body("event_id", _PRICE_BODIES)} as body from events
union all
select 'C' || c_custkey, 'company', {_body("c_custkey", _COMPANY_BODIES)} from customer"""


@query(
    "classify_response",
    f"""
with responses as ({_RESPONSES}), parsed as (
  select symbol, kind, coalesce(json_valid(body), false) as valid,
    case when json_valid(body) and json_type(body) = 'OBJECT' then body end as doc
  from responses
), texts as (
  select symbol, kind, valid, doc is not null as is_object,
    json_exists(doc, '$."Error Message"') as has_error,
    lower(json_extract_string(doc, '$."Error Message"')) as error,
    json_exists(doc, '$."Information"') as has_notice,
    lower(json_extract_string(doc, '$."Information"')) as notice,
    json_exists(doc, case kind when 'prices' then '$."Time Series (Daily)"' else '$."Name"' end) as succeeded
  from parsed
), judged as (
  select symbol, case
    when not valid then 'transport_error'
    when not is_object then 'unknown'
    when has_error and error like '%api key%' then 'invalid_key'
    when has_error and error like '%symbol%' then 'invalid_symbol'
    when has_error then 'unrecognized_error'
    when has_notice and notice like '%remove%' then 'daily_quota'
    when has_notice and notice like '%1 request%' then 'rate_limited'
    when has_notice then 'unrecognized_info'
    when succeeded then 'ok'
    else 'unknown' end as outcome
  from texts
)
select symbol, outcome, outcome in ('transport_error', 'rate_limited', 'unknown') as retryable from judged""",
)
def classify_response(spark, sf):
    """Answers of both kinds, made of all events and customers; some are cut off or go on too long."""
    events = g.given(spark, sf, "events").selectExpr(
        "'E' || event_id as symbol", "'prices' as kind", f"{_body('event_id', _PRICE_BODIES)} as body"
    )
    customers = g.given(spark, sf, "customer").selectExpr(
        "'C' || c_custkey as symbol", "'company' as kind", f"{_body('c_custkey', _COMPANY_BODIES)} as body"
    )
    return src.classify_response(events.union(customers)).select("symbol", "outcome", "retryable")


# -- figures at query time --------------------------------------------------


@query(
    "day_over_day",
    g.sql(
        """
select ticker, date, close_price, close_price - p as change,
  cast(close_price - p as double) / cast(nullif(p, 0) as double) * 100 as pct_change
from (select *, lag(close_price) over (partition by ticker order by date) as p from bars)""",
        "bars",
    ),
)
def day_over_day(spark, sf):
    return op.day_over_day(g.bars(spark, sf))


@query(
    "moving_average",
    g.sql(
        """
select ticker, date, close_price,
  cast(sum(close_price) over w as double) / count(close_price) over w as moving_average
from bars
window w as (partition by ticker order by date rows between 4 preceding and current row)""",
        "bars",
    ),
)
def moving_average(spark, sf):
    return op.moving_average(g.bars(spark, sf), 5)


@query(
    "price_range",
    g.sql("select ticker, date, high_price - low_price as price_range from bars", "bars"),
)
def price_range(spark, sf):
    return op.price_range(g.bars(spark, sf))


# -- the jobs, end to end ---------------------------------------------------

for _name, (_run, _oracle) in scenario.QUERIES.items():
    query(_name, _oracle)(_run)
