"""Price-shaped rows from the given tables, in Spark and in SQL.

The given tables hold no prices, so bars come from ``events`` (one per user and
day) and the dimension from ``customer``. Faults are put into the raw text by
rule, so that every check has something to find. All rows are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barhouse.schemas import BAR_FIELDS, PRICE, PRICE_COLS, VALUE_COLS

# The increment starts after MARK; the table to merge into holds bars before TARGET_END.
MARK, TARGET_END = "2024-01-15 00:00:00", "2024-01-20"
NEW_SECTOR = "MACHINERY"


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mark() -> Column:
    return F.lit(MARK).cast("timestamp")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per user and day: first, highest, lowest and last value, and their number."""
    moment = F.struct("ts", "event_id")
    return (
        events(spark, sf_dir)
        .groupBy(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
            F.to_date("ts").alias("date"),
        )
        .agg(
            F.min_by("value", moment).cast(PRICE).alias("open_price"),
            F.max("value").cast(PRICE).alias("high_price"),
            F.min("value").cast(PRICE).alias("low_price"),
            F.max_by("value", moment).cast(PRICE).alias("close_price"),
            F.count("*").cast("int").alias("volume"),
            F.max("ts").alias("loaded_at"),
            F.min("event_id").alias("k"),
        )
    )


def text_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as text, without faults."""
    return bars(spark, sf_dir).select(
        "ticker",
        F.col("date").cast("string").alias("date"),
        *[F.col(c).cast("string").alias(c) for c in VALUE_COLS],
        "loaded_at",
        "k",
        F.col("date").alias("day"),
    )


#: From these days on a seventh of the tickers has a new name, and a third of those another one.
RENAMED, RENAMED_AGAIN = "2024-01-20", "2024-01-25"


def renamed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of renamed tickers: U7 ends and R7 has its history, some closes corrected; R21 ends too and S21 goes on.

    Others only look like it: L has a third of the bars of a ticker that ended, N is a cent off, and the bars of
    all Z are the same on every day.
    """
    n = F.substring("ticker", 2, 12).cast("bigint")
    all_ = bars(spark, sf_dir).drop("loaded_at").withColumn("n", n)
    seventh, more = F.col("n") % 7 == 0, F.col("n") % 21 == 0

    def named(letter: str, rows: DataFrame, **changed: Column) -> DataFrame:
        values = {c: v.cast("int" if c == "volume" else PRICE) for c, v in changed.items()}
        return rows.withColumn("ticker", F.concat(F.lit(letter), F.col("n").cast("string"))).withColumns(values)

    def raised(test: Column, by: str) -> Column:
        return F.when(test, F.col("close_price") + F.lit(by).cast(PRICE)).otherwise(F.col("close_price"))

    flat = {c: F.lit(1) for c in VALUE_COLS}
    parts = [
        all_.where(~seventh | (F.col("date") < F.lit(RENAMED))),
        named("R", all_.where(seventh & (~more | (F.col("date") < F.lit(RENAMED_AGAIN)))), close_price=raised(every(13), "1")),
        named("S", all_.where(more), close_price=raised(every(17), "1")),
        named("L", all_.where(seventh), close_price=raised(~every(3), "3")),
        named("N", all_.where(n % 11 == 3), close_price=raised(F.lit(True), "0.01")),
        named("Z", all_.where((n % 10 == 5) | ((n % 5 == 0) & (F.col("date") < F.lit("2024-01-12")))), **flat),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("n", "k")


def every(n: int) -> Column:
    return F.col("k") % n == 0


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars as a raw table would hold them: text, padded tickers, faults."""
    swap = every(47) & ~every(41)
    return text_bars(spark, sf_dir).select(
        F.concat(F.lit("  "), "ticker", F.lit(" ")).alias("ticker"),
        F.when(every(89), F.replace("date", F.lit("2024-01"), F.lit("2024-99")))
        .otherwise(F.col("date"))
        .alias("date"),
        F.when(every(31), "N/A")
        .when(every(37), "0")
        .otherwise(F.col("open_price"))
        .alias("open_price"),
        F.when(every(41), "-5.00")
        .when(swap, F.col("low_price"))
        .otherwise(F.col("high_price"))
        .alias("high_price"),
        F.when(swap, F.col("high_price")).otherwise(F.col("low_price")).alias("low_price"),
        "close_price",
        F.when(every(43), "3000000000").otherwise(F.col("volume")).alias("volume"),
        "loaded_at",
        "k",
        "day",
    )


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in credit as companies; the others are the tickers nobody knows."""
    return companies(spark, sf_dir).where("c_acctbal >= 0").drop("c_acctbal")


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as companies."""
    joined = (
        given(spark, sf_dir, "customer")
        .join(given(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(given(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        (F.col("c_custkey") + 1).cast("int").alias("ticker_id"),
        F.concat(F.lit("U"), F.col("c_custkey").cast("string")).alias("ticker"),
        F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("sector"),
        F.col("n_name").alias("industry"),
        F.substring("r_name", 1, 10).alias("exchange"),
        F.lit("USD").alias("currency"),
        F.col("n_name").alias("country"),
        "c_acctbal",
    )


def known_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension before the newest sector was added."""
    return dim(spark, sf_dir).where(F.col("sector") != NEW_SECTOR)


def in_tens(text: DataFrame) -> DataFrame:
    """Name the document each bar goes to: ten neighbouring tickers share one."""
    ten = F.expr("cast(substring(ticker, 2) as bigint) div 10")
    return text.withColumn("symbol", F.concat(F.lit("T"), ten.cast("string")))


def price_documents(text: DataFrame) -> DataFrame:
    """One JSON document per symbol: ``{ticker: {date: {field: text}}}``.

    The symbol is the ticker unless ``text`` has a column of that name. A ticker
    has at most one bar per day, so a document is bounded by the calendar.
    """
    pairs = [x for c, name in BAR_FIELDS.items() for x in (F.lit(name), F.col(c))]
    fields = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    dates = F.map_from_entries(F.collect_list(F.struct("date", fields)))
    by = ["symbol", "ticker"] if "symbol" in text.columns else ["ticker"]
    docs = text.groupBy(*by).agg(dates.alias("dates"), F.max("loaded_at").alias("run_ts"))
    if "symbol" not in text.columns:
        body = F.to_json(F.create_map("ticker", "dates"))
        return docs.select(F.col("ticker").alias("symbol"), "run_ts", body.alias("body"))
    tickers = F.map_from_entries(F.collect_list(F.struct("ticker", "dates")))
    return docs.groupBy("symbol").agg(
        F.max("run_ts").alias("run_ts"), F.to_json(tickers).alias("body")
    )


#: Characters of real symbols that file names and addresses treat in their own ways.
ODD = ("^", " ", "%", "/", ":", "+", "#", "%41")


def odd_tickers(text: DataFrame) -> DataFrame:
    """Tickers with a character between the letter and the number, by the number."""
    number = F.substring("ticker", 2, 12)
    mark = F.array(*[F.lit(x) for x in ODD])[(number.cast("bigint") % len(ODD)).cast("int")]
    return text.withColumn("ticker", F.concat(F.lit("U"), mark, number))


ODD_SQL = "'U' || [{}][cast(substr(ticker, 2) as bigint) % {} + 1] || substr(ticker, 2)".format(
    ", ".join(f"'{x}'" for x in ODD), len(ODD)
)


def daily_responses(text: DataFrame) -> DataFrame:
    """What the price service answers: one envelope per ticker (``symbol, run_ts, body``)."""
    pairs = [x for c, name in BAR_FIELDS.items() for x in (F.lit(name), F.col(c))]
    dates = F.map_from_entries(F.collect_list(F.struct("date", F.create_map(*pairs))))
    found = text.groupBy(F.col("ticker").alias("symbol")).agg(
        dates.alias("dates"), F.max("loaded_at").alias("run_ts")
    )
    body = F.to_json(F.struct(F.col("dates").alias("Time Series (Daily)")))
    return found.select("symbol", "run_ts", body.alias("body"))


def company_documents(companies: DataFrame) -> DataFrame:
    doc = F.struct(
        F.col("ticker").alias("Symbol"),
        F.col("company_name").alias("Name"),
        F.col("sector").alias("Sector"),
        F.col("industry").alias("Industry"),
        F.col("exchange").alias("Exchange"),
        F.col("currency").alias("Currency"),
        F.col("country").alias("Country"),
    )
    return companies.select(F.col("ticker").alias("symbol"), F.to_json(doc).alias("body"))


def control_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control table with one load per user seen before the mark."""
    return (
        events(spark, sf_dir)
        .where(F.col("ts") < mark())
        .groupBy(load_name("user_id"))
        .agg(F.max("ts").alias("last_run"), F.min("ts").alias("high_mark"))
    )


def load_name(c: str) -> Column:
    return F.concat(F.lit("load_U"), F.col(c).cast("string")).alias("procedure_name")


# -- the same in SQL --------------------------------------------------------

_PRICES = ", ".join(PRICE_COLS)
_RAISED = "open_price, high_price, low_price, cast(case when {} then close_price + {} else close_price end as decimal(11,4))"

SQL = {
    "bars": """
        select 'U' || user_id as ticker, cast(ts as date) as date,
          cast(arg_min(value, (ts, event_id)) as decimal(11,4)) as open_price,
          cast(max(value) as decimal(11,4)) as high_price,
          cast(min(value) as decimal(11,4)) as low_price,
          cast(arg_max(value, (ts, event_id)) as decimal(11,4)) as close_price,
          cast(count(*) as int) as volume, max(ts) as loaded_at, min(event_id) as k
        from events group by 1, 2""",
    "text_bars": """
        select ticker, cast(date as varchar) as date, cast(open_price as varchar) as open_price,
          cast(high_price as varchar) as high_price, cast(low_price as varchar) as low_price,
          cast(close_price as varchar) as close_price, cast(volume as varchar) as volume,
          loaded_at, k, date as day
        from bars""",
    "raw_bars": """
        select '  ' || ticker || ' ' as ticker,
          case when k % 89 = 0 then replace(date, '2024-01', '2024-99') else date end as date,
          case when k % 31 = 0 then 'N/A' when k % 37 = 0 then '0' else open_price end
            as open_price,
          case when k % 41 = 0 then '-5.00' when k % 47 = 0 then low_price else high_price end
            as high_price,
          case when k % 47 = 0 and k % 41 <> 0 then high_price else low_price end as low_price,
          close_price, case when k % 43 = 0 then '3000000000' else volume end as volume,
          loaded_at, k, day
        from text_bars""",
    "typed": """
        select trim(ticker) as ticker, try_cast(date as date) as date,
          try_cast(open_price as decimal(11,4)) as open_price,
          try_cast(high_price as decimal(11,4)) as high_price,
          try_cast(low_price as decimal(11,4)) as low_price,
          try_cast(close_price as decimal(11,4)) as close_price,
          try_cast(volume as int) as volume, loaded_at
        from raw_bars""",
    "silver": f"select * from typed where loaded_at > timestamp '{MARK}'",
    "target": f"""
        select ticker, date, {_PRICES}, volume, loaded_at
        from bars where date < date '{TARGET_END}'""",
    "source": "select * from silver where date is not null",
    "companies": """
        select cast(c_custkey + 1 as int) as ticker_id, 'U' || c_custkey as ticker,
          c_name as company_name, c_mktsegment as sector, n_name as industry,
          substr(r_name, 1, 10) as exchange, 'USD' as currency, n_name as country, c_acctbal
        from customer join nation on c_nationkey = n_nationkey
          join region on n_regionkey = r_regionkey""",
    "dim": "select * exclude (c_acctbal) from companies where c_acctbal >= 0",
    "known_dim": f"select * from dim where sector <> '{NEW_SECTOR}'",
    "renamed_bars": f"""
        select 'U' || n as ticker, date, {_PRICES}, volume from numbered
        where n % 7 <> 0 or date < date '{RENAMED}'
        union all
        select 'R' || n, date, {_RAISED.format("k % 13 = 0", "1")}, volume from numbered
        where n % 7 = 0 and (n % 21 <> 0 or date < date '{RENAMED_AGAIN}')
        union all
        select 'S' || n, date, {_RAISED.format("k % 17 = 0", "1")}, volume from numbered where n % 21 = 0
        union all
        select 'L' || n, date, {_RAISED.format("k % 3 <> 0", "3")}, volume from numbered where n % 7 = 0
        union all
        select 'N' || n, date, {_RAISED.format("true", "0.01")}, volume from numbered where n % 11 = 3
        union all
        select 'Z' || n, date, 1, 1, 1, 1, 1 from numbered
        where n % 10 = 5 or (n % 5 = 0 and date < date '2024-01-12')""",
    "numbered": "select *, cast(substr(ticker, 2) as bigint) as n from bars",
    "control": f"""
        select 'load_U' || user_id as procedure_name, max(ts) as last_run, min(ts) as high_mark
        from events where ts < timestamp '{MARK}' group by 1""",
    "customers": "select 'load_U' || c_custkey as procedure_name from customer",
}

_NEEDS = {
    "text_bars": ["bars"],
    "raw_bars": ["text_bars"],
    "typed": ["raw_bars"],
    "silver": ["typed"],
    "target": ["bars"],
    "source": ["silver"],
    "numbered": ["bars"],
    "renamed_bars": ["numbered"],
    "dim": ["companies"],
    "known_dim": ["dim"],
}


def sql(query: str, *names: str) -> str:
    """``query`` with the named derivations, and what they need, in front."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    return "with " + ", ".join(f"{n} as ({SQL[n]})" for n in order) + "\n" + query
