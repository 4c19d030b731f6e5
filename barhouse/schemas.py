"""Table schemas, keys and text widths of the warehouse."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(11, 4)

PRICE_COLS = ("open_price", "high_price", "low_price", "close_price")
VALUE_COLS = (*PRICE_COLS, "volume")
BAR_KEYS = ("ticker", "date")
FACT_KEYS = ("ticker_id", "date")

# Field names inside a price document, by column.
BAR_FIELDS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
    "volume": "5. volume",
}

# Key names inside a company document, by column.
COMPANY_FIELDS = {
    "ticker": "Symbol",
    "company_name": "Name",
    "sector": "Sector",
    "industry": "Industry",
    "exchange": "Exchange",
    "currency": "Currency",
    "country": "Country",
}

# The longest text each column may hold.
BRONZE_WIDTHS = {c: 12 for c in (*BAR_KEYS, *VALUE_COLS)}
DIM_WIDTHS = {
    "ticker": 12,
    "company_name": 100,
    "sector": 100,
    "industry": 100,
    "exchange": 10,
    "currency": 3,
    "country": 50,
}


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(*f) for f in fields])


BRONZE = _struct(
    *[(c, T.StringType()) for c in (*BAR_KEYS, *VALUE_COLS)],
    ("loaded_at", T.TimestampType()),
    ("file_stamp", T.StringType()),
    ("source_file", T.StringType()),
    ("file_pos", T.IntegerType()),
)

# Which version of a raw bar is current: the newest load, then the newest run
# stamp in the file name, then the file name, then the place in the file.
VERSION_ORDER = ("loaded_at", "file_stamp", "source_file", "file_pos")

FILES = _struct(
    ("source_file", T.StringType()),
    ("modified_at", T.TimestampType()),
    ("symbol", T.StringType()),
    ("file_stamp", T.StringType()),
    ("status", T.StringType()),
    ("reason", T.StringType()),
    ("bars", T.IntegerType()),
    ("loaded_at", T.TimestampType()),
)

SILVER = _struct(
    ("ticker", T.StringType()),
    ("date", T.DateType()),
    *[(c, PRICE) for c in PRICE_COLS],
    ("volume", T.IntegerType()),
    ("loaded_at", T.TimestampType()),
)

# A quarantined bar keeps its raw text and the run that refused it.
REJECTS = _struct(*[(f.name, f.dataType) for f in BRONZE], ("run_id", T.StringType()))

DIM = _struct(
    ("ticker_id", T.IntegerType(), False),
    *[(c, T.StringType(), c not in ("ticker", "company_name")) for c in DIM_WIDTHS],
)

FACT = _struct(
    ("ticker_id", T.IntegerType(), False),
    ("date", T.DateType(), False),
    *[(c, PRICE) for c in PRICE_COLS],
    ("volume", T.IntegerType()),
)

# Stored figures of each bar, and the number of bars that tells which periods a change reaches.
DERIVED = _struct(
    ("ticker", T.StringType()),
    ("date", T.DateType()),
    ("close_price", PRICE),
    ("change", T.DecimalType(12, 4)),
    ("pct_change", T.DoubleType()),
    ("moving_average", T.DoubleType()),
)

BAR_COUNTS = _struct(
    ("ticker", T.StringType()), ("period", T.StringType()), ("bars", T.IntegerType())
)

# How many rows of a part of the typed table each report finds; a part never changes.
PART_QUALITY = _struct(
    ("path", T.StringType()), ("report", T.StringType()), ("row_count", T.LongType())
)

UNMATCHED = _struct(
    ("ticker", T.StringType()), ("period", T.StringType()), ("run_id", T.StringType())
)

LOAD_LOG = _struct(
    ("procedure_name", T.StringType()),
    ("last_run", T.TimestampType()),
    ("high_mark", T.TimestampType()),
)

RUN_LOG = _struct(
    ("run_id", T.StringType()),
    ("job", T.StringType()),
    ("started_at", T.TimestampType()),
    ("finished_at", T.TimestampType()),
    ("outcome", T.StringType()),
    ("inserted", T.LongType()),
    ("updated", T.LongType()),
    ("detail", T.StringType()),
)

# One row per change of a table part; see the warehouse module.
TABLE_LOG = _struct(
    ("seq", T.LongType()),
    ("table_name", T.StringType()),
    ("part", T.StringType()),
    ("path", T.StringType()),
    ("stamp", T.LongType()),
    ("n_rows", T.LongType()),
)

LOAD_NAMES = _struct(("procedure_name", T.StringType()))

ACTIONS = _struct(("action_taken", T.StringType()), ("row_count", T.LongType()))

TABLES = {
    "bronze.stocks_prices": BRONZE,
    "bronze.files": FILES,
    "silver.stocks_prices": SILVER,
    "silver.rejects": REJECTS,
    "silver.part_quality": PART_QUALITY,
    "gold.dim_ticker": DIM,
    "gold.fact_stock_prices": FACT,
    "gold.unmatched_tickers": UNMATCHED,
    "gold.derived_prices": DERIVED,
    "gold.bar_counts": BAR_COUNTS,
    "pipeline.load_log": LOAD_LOG,
    "pipeline.run_log": RUN_LOG,
}

# Tables that can be computed again from the layer below, with the load to repeat.
REBUILDABLE = {
    "silver.stocks_prices": "load_silver",
    "gold.fact_stock_prices": "load_gold",
}
LOADS = tuple(REBUILDABLE.values())

# Tables that are kept by period of the date.
PERIODIC = (*REBUILDABLE, "gold.derived_prices")
