"""The jobs end to end on the given tables: two deliveries through all layers.

First delivery: the bars of all days before ``FIRST_END``, and the companies
known by then. Second delivery: the bars from ``SECOND_START`` on with corrected
closes (so the deliveries overlap), some documents of which lack a field, and
all companies. The fact rows the first delivery had to leave out are added last.
A document holds ten neighbouring tickers.
"""

from __future__ import annotations

import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barhouse.operators import quality_details as operators_quality
from barhouse.plans import given as g
from barhouse.plans import loads, quality, scripts
from barhouse.plans.derived import DERIVED, load_derived
from barhouse.plans.lookup import key_lookup
from barhouse.plans.repair import repair
from barhouse.plans.scratch import drop_path, few_rows, new_folder
from barhouse.plans.warehouse import Warehouse
from barhouse.schemas import BAR_KEYS, DIM_WIDTHS, FACT_KEYS, PRICE_COLS, VALUE_COLS
from barhouse.sources.price_files import write_raw
from barhouse.streaming import stream_bronze, stream_silver

_BUILT: dict[tuple[str, ...], str] = {}

FIRST_END, SECOND_START = "2024-01-20", "2024-01-10"
FIRST_RUN = "run_stamp=2024-02-01_00-00-00"


def _corrected(c: str):
    return (F.col(c).cast("decimal(11,4)") + 1).cast("decimal(11,4)").cast("string")


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The documents of both deliveries."""
    raw = g.raw_bars(spark, sf_dir).withColumn("ticker", F.trim("ticker"))
    second = (
        raw.where(F.col("day") >= F.lit(SECOND_START))
        .withColumn("close_price", _corrected("close_price"))
        .withColumn("high_price", F.when(~g.every(997), F.col("high_price")))
    )
    deliveries = ((raw.where(F.col("day") < F.lit(FIRST_END)), "2024-02-01"), (second, "2024-02-02"))
    return tuple(
        g.price_documents(g.in_tens(text)).withColumn("run_ts", F.lit(stamp).cast("timestamp")) for text, stamp in deliveries
    )


def _deliver(wh: Warehouse, landing: str, docs: DataFrame) -> None:
    write_raw(docs, landing)
    loads.load_bronze(wh, landing)
    loads.load_silver(wh, on_bad_key="quarantine")


def _companies(dim: DataFrame, stamp: str) -> DataFrame:
    return g.company_documents(dim).withColumn("received_at", F.lit(stamp).cast("timestamp"))


def _build(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark)
    landing = f"{folder}/landing"
    wh = Warehouse(spark, f"{folder}/warehouse").create()
    first, second = _documents(spark, sf_dir)

    loads.load_dim(wh, _companies(g.known_dim(spark, sf_dir), "2024-02-01"))
    _deliver(wh, landing, first)
    loads.load_gold(wh)

    loads.load_dim(wh, _companies(g.dim(spark, sf_dir), "2024-02-02"))
    _deliver(wh, landing, second)
    loads.load_gold(wh)
    loads.backfill_unmatched(wh)
    return wh.root


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse after both deliveries; built once per application and scale."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUILT:
        _BUILT[key] = _build(spark, sf_dir)
    return Warehouse(spark, _BUILT[key])


# -- expected state in SQL --------------------------------------------------

_BAR = ", ".join((*BAR_KEYS, *VALUE_COLS))
_FACT = ", ".join((*FACT_KEYS, *VALUE_COLS))

_TENS = "'T' || cast(substr(trim(ticker), 2) as bigint) // 10 as symbol"

_SQL = f"""
first as (
  select trim(ticker) as ticker, {_TENS}, date, {", ".join(VALUE_COLS)}, k
  from raw_bars where day < date '{FIRST_END}'),
second_all as (
  select trim(ticker) as ticker, {_TENS}, date, open_price, high_price, low_price,
    cast(cast(cast(close_price as decimal(11,4)) + 1 as decimal(11,4)) as varchar) as close_price,
    volume, k
  from raw_bars where day >= date '{SECOND_START}'),
second as (
  select * from second_all
  where symbol not in (select symbol from second_all where k % 997 = 0)),
current as (
  select {_BAR} from second
  union all
  select {_BAR} from first f where not exists (
    select 1 from second s where s.ticker = f.ticker and s.date = f.date)),
bars_now as (
  select ticker, try_cast(date as date) as date,
    {", ".join(f"try_cast({c} as decimal(11,4)) as {c}" for c in PRICE_COLS)},
    try_cast(volume as int) as volume
  from current where try_cast(date as date) is not null),
ids as (
  select cast(row_number() over (order by sector = '{g.NEW_SECTOR}', ticker) as int) as ticker_id,
    {", ".join(DIM_WIDTHS)} from dim),
facts as (
  select ticker_id, date, {", ".join(VALUE_COLS)} from bars_now join ids using (ticker))"""


def _oracle(query: str) -> str:
    return g.sql("", "raw_bars", "known_dim").rstrip() + "," + _SQL + "\n" + query


def bronze_state(spark, sf):
    return loads.bronze_current(warehouse(spark, sf)).select(*BAR_KEYS, *VALUE_COLS)


def _other(spark, sf, name: str, build, period: str | None = None) -> Warehouse:
    """Another warehouse over the same landing folder, built once."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _BUILT:
        folder = warehouse(spark, sf).root.removesuffix("/warehouse")
        wh = Warehouse(spark, f"{folder}/{name}", period).create()
        build(wh, folder, f"{folder}/landing")
        _BUILT[key] = wh.root
    return Warehouse(spark, _BUILT[key])


def bronze_stream(spark, sf):
    """Both deliveries read by streams, the second after the checkpoint was lost and made anew."""

    def build(wh, folder, landing):
        checkpoint = f"{folder}/checkpoint"
        stream_bronze(wh, f"{landing}/{FIRST_RUN}", checkpoint).awaitTermination()
        drop_path(spark, checkpoint)
        stream_bronze(wh, landing, checkpoint).awaitTermination()

    current = loads.bronze_current(_other(spark, sf, "stream_warehouse", build))
    return current.select(*BAR_KEYS, *VALUE_COLS)


def _second_life(spark, sf) -> Warehouse:
    """The same deliveries with failing runs, created twice, compacted, rebuilt and loaded again."""

    def build(wh, folder, landing):
        Warehouse(spark, wh.root).create()
        loads.load_dim(wh, _companies(g.known_dim(spark, sf), "2024-02-01"))
        loads.load_bronze(wh, f"{landing}/{FIRST_RUN}")
        loads.run_silver(wh)  # refused: some dates cannot be read
        loads.run_silver(wh, on_bad_key="quarantine")
        loads.run_gold(wh)
        loads.load_dim(wh, _companies(g.dim(spark, sf), "2024-02-02"))
        loads.load_bronze(wh, landing)
        loads.run_silver(wh, on_bad_key="quarantine")
        loads.run_gold(wh)
        loads.compact_bronze(wh)
        wh.rebuild(loads.SILVER)
        wh.rebuild(loads.FACT)
        loads.run_silver(wh, on_bad_key="quarantine")
        loads.run_gold(wh)

    return _other(spark, sf, "second_life", build)


def bronze_compacted(spark, sf):
    """What is stored after a compaction: one version of each key, without looking for the newest."""
    return _second_life(spark, sf).table(loads.BRONZE).select(*BAR_KEYS, *VALUE_COLS)


def reloaded_facts(spark, sf):
    return _second_life(spark, sf).table(loads.FACT).select(*FACT_KEYS, *VALUE_COLS)


def _load_all(wh: Warehouse, sf: str, landing: str) -> None:
    loads.load_dim(wh, _companies(g.dim(wh.spark, sf), "2024-02-02"))
    for src in (f"{landing}/{FIRST_RUN}", landing):
        loads.load_bronze(wh, src)
        loads.load_silver(wh, on_bad_key="quarantine")
        loads.load_gold(wh)


def _damage(wh: Warehouse, name: str, periods: list[str], keys) -> None:
    """Take some rows of the periods away and change a value of others."""
    stamp = wh.next_stamp(name)
    lot = F.pmod(F.xxhash64(*keys), F.lit(7))
    rows = wh.table(name, periods).where(lot != 0)
    rows = rows.withColumn("volume", F.when(lot == 1, F.col("volume") + 1).otherwise(F.col("volume")))
    wh.commit(wh.write_periods(name, rows, f"damage-{stamp}", wh.parts(name)[0].stamp, tuple(keys)))


def repaired_facts(spark, sf):
    """A warehouse kept by days: rows of two days of the typed and of two of the fact table are lost or changed, then repaired."""

    def build(wh, folder, landing):
        _load_all(wh, sf, landing)
        _damage(wh, loads.SILVER, ["2024-01-05", "2024-01-17"], BAR_KEYS)
        _damage(wh, loads.FACT, ["2024-01-17", "2024-01-23"], FACT_KEYS)
        repair(wh)

    return _other(spark, sf, "repaired_warehouse", build, "day").table(loads.FACT).select(*FACT_KEYS, *VALUE_COLS)


def _kept(spark, sf) -> Warehouse:
    """A warehouse kept by days, with stored figures and quality counts brought up to date after each delivery."""

    def build(wh, folder, landing):
        for src in (f"{landing}/{FIRST_RUN}", landing):
            loads.load_bronze(wh, src)
            loads.load_silver(wh, on_bad_key="quarantine")
            load_derived(wh)
            quality.quality_counts(wh)

    return _other(spark, sf, "kept_warehouse", build, "day")


def derived_incremental(spark, sf):
    return _kept(spark, sf).table(DERIVED)


def quality_incremental(spark, sf):
    return quality.quality_report(_kept(spark, sf))


def silver_stream(spark, sf):
    """Three runs of the typed stream from one checkpoint: the first delivery but for one document, the second one with
    its corrections, and the missing document of the first, which is older by then."""

    def build(wh, folder, landing):
        checkpoint, src = f"{folder}/silver_checkpoint", f"{folder}/silver_landing"
        first, second = _documents(spark, sf)
        late = F.col("symbol") == "T1"
        for name, docs in (("a", first.where(~late)), ("b", second), ("c", first.where(late))):
            write_raw(docs, f"{src}/{name}")
            stream_silver(wh, src, checkpoint).awaitTermination()

    return _other(spark, sf, "silver_stream_warehouse", build).table(loads.SILVER).select(*BAR_KEYS, *VALUE_COLS)


def script_load(spark, sf):
    """Both deliveries loaded by SQL scripts from the raw rows in the catalog, between them a script that fails."""
    key = (spark.sparkContext.applicationId, sf, "scripts")
    if key not in _BUILT:
        wh = warehouse(spark, sf)
        prefix = f"s{uuid.uuid4().hex[:12]}"
        scripts.create_tables(spark, prefix)
        wh.table(loads.DIM).write.insertInto(f"{prefix}_dim")
        raw = wh.table(loads.BRONZE)
        newest = raw.agg(F.max("loaded_at")).first()[0]
        for rows in (raw.where(F.col("loaded_at") < F.lit(newest)), raw):
            rows.createOrReplaceTempView(f"{prefix}_bronze")
            scripts.run_script(spark, scripts.silver_script(prefix, f"{prefix}_bronze"))  # refused: unreadable dates
            scripts.run_script(spark, scripts.silver_script(prefix, f"{prefix}_bronze", quarantine=True))
            scripts.run_script(spark, scripts.gold_script(prefix))
        spark.catalog.dropTempView(f"{prefix}_bronze")
        _BUILT[key] = prefix
    return spark.table(f"{_BUILT[key]}_fact").select(*FACT_KEYS, *VALUE_COLS)


#: Rows for the dimension by the number of the customer, each kind inserted by itself: what is wrong with it.
_KINDS = {
    "fine": "c_name",
    "no_name": "cast(null as string)",
    "long_name": "repeat(c_name, 9)",
    "long_ticker": "c_name",
    "repeated": "c_name",
}


def insert_outcomes(spark, sf):
    """All customers inserted into a dimension of the catalog, by kind of row: what is accepted, and why the rest is not."""
    prefix = f"i{uuid.uuid4().hex[:12]}"
    scripts.create_tables(spark, prefix)
    table, view = f"{prefix}_dim", f"{prefix}_customer"
    g.given(spark, sf, "customer").createOrReplaceTempView(view)
    outcomes = []
    for number, (kind, name) in enumerate(_KINDS.items()):
        ticker = "concat('TICKER_', lpad(c_custkey, 9, '0'))" if kind == "long_ticker" else "concat('U', c_custkey)"
        twice = " lateral view explode(array(1, 2)) t as copy" if kind == "repeated" else ""
        query = (
            f"select cast(c_custkey as int) as ticker_id, {ticker} as ticker, {name} as company_name "
            f"from {view}{twice} where c_custkey % {len(_KINDS)} = {number}"
        )
        columns = ["ticker_id", "ticker", "company_name"]
        try:
            scripts.checked_insert(spark, table, columns, query, columns)
            reason = None
        except PySparkException as e:
            reason = next(r for r in ("EXCEED_LIMIT_LENGTH", "NULL in a required column", "repeated key") if r in str(e))
        outcomes.append((kind, reason is None, reason))
    n = spark.table(table).count()
    schema = T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("accepted", T.BooleanType()), T.StructField("reason", T.StringType())]
    )
    spark.sql(f"drop view {view}")
    for name in ("silver", "rejects", "dim", "fact", "load_log", "run_log"):
        spark.sql(f"drop table {prefix}_{name}")
    return few_rows(spark, outcomes, schema).withColumn("rows_in_table", F.lit(n).cast("long"))


def looked_up(spark, sf):
    """The typed bars of customers in debt, most of whom have none."""
    debtors = g.given(spark, sf, "customer").where("c_acctbal < 0").selectExpr("concat('U', c_custkey) as ticker")
    return key_lookup(warehouse(spark, sf), loads.SILVER, debtors).select(*BAR_KEYS, *VALUE_COLS)


def load_stamps(spark, sf):
    """A load stamps all its rows alike, and none is without a stamp."""
    rows = _second_life(spark, sf).table(loads.SILVER)
    return rows.agg(
        F.count("*").alias("bars"),
        F.count("loaded_at").alias("stamped"),
        F.count_distinct("loaded_at").alias("stamps"),
    )


def runner_audit(spark, sf):
    """What the runners' loads recorded, a refused one among them."""
    runs = _second_life(spark, sf).table(loads.RUN_LOG_TABLE)
    order = Window.partitionBy("job").orderBy("started_at")
    return runs.where("job in ('load_silver', 'load_gold')").select(
        "job", F.row_number().over(order).alias("run_no"), "outcome", "detail"
    )


def quality_details(spark, sf):
    """All rows of the three reports, as the job writes them."""
    found = loads.check_data_quality(warehouse(spark, sf))
    schema = operators_quality(warehouse(spark, sf).table(loads.SILVER)).schema
    return spark.read.schema(schema).parquet(found.path)


def land_then_load(spark, sf):
    """Answers for odd symbols, landed twice and loaded with the defaults: every stored row."""

    def build(wh, folder, landing):
        responses = g.daily_responses(g.odd_tickers(g.text_bars(spark, sf)))
        for _ in range(2):
            loads.land_prices(wh, responses, f"{folder}/odd_landing")
        loads.load_bronze(wh, f"{folder}/odd_landing")

    return _other(spark, sf, "odd_warehouse", build).table(loads.BRONZE).select(*BAR_KEYS, *VALUE_COLS)


def bronze_retry(spark, sf):
    """Documents rejected by many runs, then repaired, rejected again and repaired: the bars in force, and no file left over."""

    def build(wh, folder, landing):
        text = g.in_tens(g.text_bars(spark, sf))
        stamp = F.lit("2024-03-01").cast("timestamp")
        faulty = text.withColumn("high_price", F.when(~g.every(31), F.col("high_price")))
        write_raw(g.price_documents(faulty).withColumn("run_ts", stamp), f"{folder}/mended")
        for _ in range(2):
            loads.load_bronze(wh, f"{folder}/mended")
        loads.retry_rejected(wh, f"{folder}/mended", passes=4)
        write_raw(g.price_documents(text).withColumn("run_ts", stamp), f"{folder}/mended")
        loads.load_bronze(wh, f"{folder}/mended")
        write_raw(g.price_documents(faulty).withColumn("run_ts", stamp), f"{folder}/mended")
        refused = loads.load_bronze(wh, f"{folder}/mended").rejected.select("source_file")
        open_ = loads.failed_files(wh).select("source_file")
        if not (refused.exceptAll(open_).isEmpty() and open_.exceptAll(refused).isEmpty()):
            raise loads.LoadError("failed_files does not name the documents that were loaded once and then refused")
        write_raw(g.price_documents(text).withColumn("run_ts", stamp), f"{folder}/mended")
        loads.load_bronze(wh, f"{folder}/mended")

    wh = _other(spark, sf, "retry_warehouse", build)
    left = F.lit(loads.failed_files(wh).count()).cast("long").alias("files_left")
    return loads.bronze_current(wh).select(*BAR_KEYS, *VALUE_COLS, left)


def bronze_files(spark, sf):
    """Files per delivery and verdict."""
    files = warehouse(spark, sf).table(loads.FILES)
    return files.select("symbol", "file_stamp", "status", "reason", "bars")


def silver_state(spark, sf):
    return warehouse(spark, sf).table(loads.SILVER).select(*BAR_KEYS, *VALUE_COLS)


def silver_rejects(spark, sf):
    return warehouse(spark, sf).table(loads.REJECTS).select(*BAR_KEYS, *VALUE_COLS)


def dim_state(spark, sf):
    return warehouse(spark, sf).table(loads.DIM).select("ticker_id", *DIM_WIDTHS)


def gold_state(spark, sf):
    return warehouse(spark, sf).table(loads.FACT).select(*FACT_KEYS, *VALUE_COLS)


def gold_unmatched(spark, sf):
    return warehouse(spark, sf).table(loads.UNMATCHED).select("ticker").distinct()


def quality_report(spark, sf):
    return loads.report_counts(warehouse(spark, sf).table(loads.SILVER))


def run_audit(spark, sf):
    """What each run of each load did, in the order of the runs."""
    runs = warehouse(spark, sf).table(loads.RUN_LOG_TABLE)
    order = Window.partitionBy("job").orderBy("started_at")
    return runs.select(
        "job", F.row_number().over(order).alias("run_no"), "outcome", "inserted", "updated"
    )


def star_select(spark, sf):
    """A plain SELECT over the published gold tables."""
    warehouse(spark, sf).publish("star_")
    return spark.sql(
        """
        SELECT d.sector, d.exchange, f.date, count(*) AS bars,
               max(f.close_price) AS highest_close, sum(f.volume) AS total_volume
        FROM star_gold.fact_stock_prices f
        JOIN star_gold.dim_ticker d ON f.ticker_id = d.ticker_id
        GROUP BY d.sector, d.exchange, f.date
        """
    )


_UPDATED = "exists (select 1 from {1} o where o.ticker = {0}.ticker and o.date = {0}.date)"
_GOOD = "try_cast(date as date) is not null"

_AUDIT = f"""
select 'load_dim' as job, cast(1 as int) as run_no, 'succeeded' as outcome,
  cast(count(*) as bigint) as inserted, cast(0 as bigint) as updated from known_dim
union all
select 'load_dim', 2, 'succeeded', cast(count(*) filter (sector = '{g.NEW_SECTOR}') as bigint),
  cast(count(*) filter (sector <> '{g.NEW_SECTOR}') as bigint) from dim
union all
select 'load_bronze', 1, 'succeeded', cast(count(*) as bigint), 0 from first
union all
select 'load_bronze', 2, 'succeeded', cast(count(*) as bigint), 0 from second
union all
select 'load_silver', 1, 'succeeded', cast(count(*) as bigint), 0 from first where {_GOOD}
union all
select 'load_silver', 2, 'succeeded', cast(count(*) filter (not u) as bigint),
  cast(count(*) filter (u) as bigint)
from (select {_UPDATED.format("second", "first")} as u from second where {_GOOD})
union all
select 'load_gold', 1, 'succeeded', cast(count(*) as bigint), 0
from first where {_GOOD} and ticker in (select ticker from known_dim)
union all
select 'load_gold', 2, 'succeeded', cast(count(*) filter (not u) as bigint),
  cast(count(*) filter (u) as bigint)
from (select {_UPDATED.format("second", "first")} and ticker in (select ticker from known_dim) as u
      from second where {_GOOD} and ticker in (select ticker from dim))
union all
select 'backfill_unmatched', 1, 'succeeded', cast(count(*) as bigint), 0
from first where {_GOOD} and ticker in (select ticker from dim where sector = '{g.NEW_SECTOR}')
  and not {_UPDATED.format("first", "second")}"""

_COUNTS = """
select 'price_inversion' as report, cast(count(*) as bigint) as row_count
from bars_now where high_price < low_price
union all
select 'negative_value', cast(count(*) as bigint) from bars_now
where high_price < 0 or low_price < 0 or close_price < 0 or open_price < 0 or volume < 0
union all
select 'zero_value', cast(count(*) as bigint) from bars_now
where high_price = 0 or low_price = 0 or close_price = 0 or open_price = 0 or volume = 0"""

_FILES = """
select symbol, '2024-02-01_00-00-00' as file_stamp, 'loaded' as status,
  cast(null as varchar) as reason, cast(count(*) as int) as bars from first group by 1
union all
select symbol, '2024-02-02_00-00-00',
  case when bool_or(k % 997 = 0) then 'rejected' else 'loaded' end,
  case when bool_or(k % 997 = 0) then 'missing_field' end,
  cast(case when bool_or(k % 997 = 0) then 0 else count(*) end as int)
from second_all group by 1"""

_UNMATCHED = f"""
select distinct ticker from first where {_GOOD} and ticker not in (select ticker from dim)
union
select distinct ticker from second where {_GOOD} and ticker not in (select ticker from dim)"""

_REJECTED = f"""
select {_BAR} from first where not {_GOOD}
union all select {_BAR} from second where not {_GOOD}"""

_DETAILS = "ticker, date, high_price, low_price, close_price, open_price, volume"
_ALL_DETAILS = f"""
select 'price_inversion' as report, {_DETAILS} from bars_now where high_price < low_price
union all
select 'negative_value', {_DETAILS} from bars_now
where high_price < 0 or low_price < 0 or close_price < 0 or open_price < 0 or volume < 0
union all
select 'zero_value', {_DETAILS} from bars_now
where high_price = 0 or low_price = 0 or close_price = 0 or open_price = 0 or volume = 0"""


def _counted(text: str, rows: str) -> str:
    return f"(select case when count(*) > 0 then '{text}' || count(*) end from ({rows}))"


def _unknown(rows: str, known: str) -> str:
    found = f"select distinct ticker from {rows} where {_GOOD} and ticker not in (select ticker from {known})"
    return _counted("tickers not in the dimension: ", found)


def _bad(rows: str) -> str:
    return f"select 1 from {rows} where not {_GOOD}"


_RUNNERS = f"""
select 'load_silver' as job, cast(1 as int) as run_no, 'failed' as outcome,
  (select 'LoadError: ' || count(*) || ' keys have a date that cannot be read' from ({_bad("first")})) as detail
union all select 'load_silver', 2, 'succeeded', {_counted("quarantined: ", _bad("first"))}
union all select 'load_silver', 3, 'succeeded', {_counted("quarantined: ", _bad("second"))}
union all select 'load_silver', 4, 'succeeded', {_counted("quarantined: ", _bad("current"))}
union all select 'load_gold', 1, 'succeeded', {_unknown("first", "known_dim")}
union all select 'load_gold', 2, 'succeeded', {_unknown("second", "dim")}
union all select 'load_gold', 3, 'succeeded', {_unknown("current", "dim")}"""

_STAR = """
select sector, exchange, date, cast(count(*) as bigint) as bars,
  max(close_price) as highest_close, cast(sum(volume) as bigint) as total_volume
from facts join ids using (ticker_id) group by 1, 2, 3"""

_FIGURES = """
select ticker, date, close_price, close_price - p as change,
  cast(close_price - p as double) / cast(nullif(p, 0) as double) * 100 as pct_change, moving_average
from (
  select ticker, date, close_price, lag(close_price) over (partition by ticker order by date) as p,
    cast(sum(close_price) over w as double) / count(close_price) over w as moving_average
  from bars_now window w as (partition by ticker order by date rows between 4 preceding and current row))"""

_OUTCOMES = """
select kind, reason is null as accepted, reason, n as rows_in_table
from (values ('fine', null), ('no_name', 'NULL in a required column'), ('long_name', 'EXCEED_LIMIT_LENGTH'),
  ('long_ticker', 'EXCEED_LIMIT_LENGTH'), ('repeated', 'repeated key')) t(kind, reason),
  (select count(*) as n from customer where c_custkey % 5 = 0)"""

# Here the whole dimension came first, so its ids are in the order of the tickers.
_REPAIRED = f"""
select i.ticker_id, date, {", ".join(VALUE_COLS)} from bars_now join (
  select ticker, cast(row_number() over (order by ticker) as int) as ticker_id from dim) i using (ticker)"""


QUERIES = {
    "bronze_load": (bronze_state, _oracle(f"select {_BAR} from current")),
    "bronze_stream": (bronze_stream, _oracle(f"select {_BAR} from current")),
    "bronze_files": (bronze_files, _oracle(_FILES)),
    "silver_load": (silver_state, _oracle(f"select {_BAR} from bars_now")),
    "silver_rejects": (silver_rejects, _oracle(_REJECTED)),
    "dim_load": (dim_state, _oracle("select * from ids")),
    "gold_load": (gold_state, _oracle(f"select {_FACT} from facts")),
    "gold_unmatched": (gold_unmatched, _oracle(_UNMATCHED)),
    "quality_report": (quality_report, _oracle(_COUNTS)),
    "run_audit": (run_audit, _oracle(_AUDIT)),
    "star_select": (star_select, _oracle(_STAR)),
    "bronze_compacted": (bronze_compacted, _oracle(f"select {_BAR} from current")),
    "reloaded_facts": (reloaded_facts, _oracle(f"select {_FACT} from facts")),
    "repaired_facts": (repaired_facts, _oracle(_REPAIRED)),
    "derived_incremental": (derived_incremental, _oracle(_FIGURES)),
    "quality_incremental": (quality_incremental, _oracle(_COUNTS)),
    "silver_stream": (silver_stream, _oracle(f"select {_BAR} from bars_now")),
    "key_lookup": (
        looked_up,
        _oracle(f"select {_BAR} from bars_now where ticker in (select 'U' || c_custkey from customer where c_acctbal < 0)"),
    ),
    "script_load": (script_load, _oracle(f"select {_FACT} from facts")),
    "insert_outcomes": (insert_outcomes, _OUTCOMES),
    "load_stamps": (
        load_stamps,
        _oracle("select count(*) as bars, count(*) as stamped, cast(1 as bigint) as stamps from bars_now"),
    ),
    "runner_audit": (runner_audit, _oracle(_RUNNERS)),
    "quality_details": (quality_details, _oracle(_ALL_DETAILS)),
    "land_then_load": (
        land_then_load,
        g.sql(f"select {g.ODD_SQL} as ticker, date, {', '.join(VALUE_COLS)} from text_bars", "text_bars"),
    ),
    "bronze_retry": (
        bronze_retry,
        g.sql(f"select {_BAR}, cast(0 as bigint) as files_left from text_bars", "text_bars"),
    ),
}
