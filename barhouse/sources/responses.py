"""Raw service responses: what each one means, and the document inside it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barhouse.functions import RUN_STAMP_FORMAT, contains_word
from barhouse.operators.keys import too_wide
from barhouse.schemas import COMPANY_FIELDS, DIM_WIDTHS
from barhouse.sources.price_files import read_price_files

# The keys that tell responses apart, and the words in their messages.
ERROR, NOTICE = "Error Message", "Information"
SERIES = "Time Series (Daily)"
SUCCESS_KEY = {"prices": SERIES, "company": COMPANY_FIELDS["company_name"]}
RETRYABLE = ("transport_error", "rate_limited", "unknown")


def read_responses(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Saved responses, one per file named ``{symbol}_{stamp}.json``.

    ``run_ts`` is the stamp in the name, ``received_at`` the time of the file.
    """
    return read_price_files(spark, path, glob).select(
        "symbol",
        F.col("value").alias("body"),
        F.try_to_timestamp("file_stamp", F.lit(RUN_STAMP_FORMAT)).alias("run_ts"),
        F.col("modified_at").alias("received_at"),
    )


def _documents(kind: str = "map<string,string>") -> Column:
    """The JSON documents in ``body``; other than one when text follows the document."""
    wrapped = F.concat(F.lit("["), F.col("body"), F.lit("]"))
    return F.from_json(wrapped, f"array<{kind}>", {"allowSingleQuotes": "false"})


def with_document(responses: DataFrame) -> DataFrame:
    """Add ``document``: ``body`` as JSON; NULL when it is something else, or when text follows the document.

    What is below reads ``document`` where it is given, so that a body need be parsed only once.
    """
    if "document" in responses.columns:
        return responses
    docs = F.col("docs")
    return responses.withColumn("docs", _documents()).withColumn("document", F.when(F.size(docs) == 1, docs[0])).drop("docs")


def classify_response(responses: DataFrame, kind: str | None = None) -> DataFrame:
    """Add ``outcome`` and ``retryable`` to responses (``symbol, kind, body``).

    The first matching rule decides. ``kind`` (``prices`` or ``company``) is
    read from the row unless given.
    """
    kind_col = F.lit(kind) if kind else F.col("kind")
    keys = F.col("document")
    lists = _documents("array<string>")
    is_list = (F.size(lists) == 1) & F.get(lists, F.lit(0)).isNotNull()

    def has(name: str) -> Column:
        return F.map_contains_key(keys, name)

    succeeded = F.lit(False)
    for name, key in SUCCESS_KEY.items():
        succeeded = succeeded | ((kind_col == name) & has(key))
    error, notice = keys[ERROR], keys[NOTICE]
    outcome = (
        # A list is valid JSON, only none of the known shapes.
        F.when(keys.isNull() & is_list, "unknown")
        .when(keys.isNull(), "transport_error")
        .when(has(ERROR) & contains_word(error, "api key"), "invalid_key")
        .when(has(ERROR) & contains_word(error, "symbol"), "invalid_symbol")
        .when(has(ERROR), "unrecognized_error")
        .when(has(NOTICE) & contains_word(notice, "remove"), "daily_quota")
        .when(has(NOTICE) & contains_word(notice, "1 request"), "rate_limited")
        .when(has(NOTICE), "unrecognized_info")
        .when(succeeded, "ok")
        .otherwise("unknown")
    )
    judged = with_document(responses).withColumn("outcome", outcome)
    return judged.withColumn("retryable", F.col("outcome").isin(*RETRYABLE)).select(
        *responses.columns, "outcome", "retryable"
    )


def unwrap_daily(responses: DataFrame) -> DataFrame:
    """Replace the envelope in ``body`` by ``{symbol: series}``, ready to be landed or parsed."""
    series = F.get_json_object("body", f"$['{SERIES}']")
    as_array = F.to_json(F.array("symbol"))
    name = F.expr("substring(symbol_json, 2, length(symbol_json) - 2)")
    return (
        responses.withColumn("symbol_json", as_array)
        .withColumn("series", series)
        .where("series is not null")
        .withColumn("body", F.concat(F.lit("{"), name, F.lit(":"), F.col("series"), F.lit("}")))
        .drop("symbol_json", "series")
    )


def parse_company(responses: DataFrame) -> DataFrame:
    """The seven company columns of every response that names a company."""
    keep = [c for c in responses.columns if c not in ("symbol", "kind", "body", "document")]
    fields = [F.col("document")[key].alias(col) for col, key in COMPANY_FIELDS.items()]
    named = with_document(responses).where(F.map_contains_key("document", COMPANY_FIELDS["company_name"]))
    return named.select(*fields, *keep)


def company_problem(responses: DataFrame) -> DataFrame:
    """Add ``problem`` to company responses: NULL when the row may enter the dimension."""
    complete = F.lit(True)
    for key in COMPANY_FIELDS.values():
        complete = complete & F.map_contains_key("document", key)
    typed = with_document(responses).select(
        "*", *[F.col("document")[key].alias(col) for col, key in COMPANY_FIELDS.items()]
    )
    problem = (
        F.when(~complete, "missing_field")
        .when(F.col("ticker").isNull() | F.col("company_name").isNull(), "null_key")
        .when(too_wide(DIM_WIDTHS), "too_long")
    )
    return typed.withColumn("problem", problem).select(*responses.columns, "problem")
