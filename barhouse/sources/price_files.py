"""Price documents: one JSON object ``{ticker: {date: {field: text}}}`` per file.

A file is accepted or rejected as a whole. Since a file is one row here, the
verdict is an expression on that row; no grouping or join is needed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barhouse.functions import file_stamp, file_symbol, folder_value, run_stamp, url_decoded
from barhouse.schemas import BAR_FIELDS, BRONZE_WIDTHS

# The document is parsed as the only element of an array, so that text after
# the closing brace makes it invalid instead of being ignored.
_DOCUMENT = "array<map<string,map<string,map<string,string>>>>"
_LANDED = "symbol string, document string"
# A file is read as one text, so this bounds it.
DOCUMENTS_PER_FILE = 1000
_STRICT_JSON = {"allowSingleQuotes": "false"}

NOT_JSON, BAD_SHAPE, MISSING_FIELD, TOO_LONG = (
    "not_json",
    "bad_shape",
    "missing_field",
    "too_long",
)


def list_price_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Staged files by address, path and time; their content is not opened."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("path"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
    )


def file_of(source_file: Column | str) -> Column:
    """The file that a document came from. An address never holds a bare number sign."""
    return F.substring_index(source_file, "#", 1)


def read_price_files(spark: SparkSession, path: str | list[str], glob: str = "*.json") -> DataFrame:
    """Staged documents, one row each: content and where it came from."""
    files = spark.read.option("recursiveFileLookup", "true").text(
        path, wholetext=True, pathGlobFilter=glob
    )
    return with_provenance(files)


def read_named_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The documents of these files, whatever characters their names hold."""
    return read_price_files(spark, [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths], "*")


def with_provenance(files: DataFrame) -> DataFrame:
    """One row per document, with its symbol and run stamp.

    A file is a document named ``{symbol}_{stamp}``, unless it lies in a folder of
    :func:`write_raw`: there each line is a document with its symbol.
    """
    name, path = F.col("_metadata.file_name"), F.col("_metadata.file_path")
    lines = F.filter(F.split("value", "\n"), lambda x: x != "")
    landed = F.transform(
        lines,
        lambda x, i: F.struct(
            F.from_json(x, _LANDED).alias("doc"), F.concat(path, F.lit("#"), i.cast("string")).alias("id")
        ),
    )
    alone = F.struct(
        F.struct(file_symbol(url_decoded(name)).alias("symbol"), F.col("value").alias("document")).alias("doc"),
        path.alias("id"),
    )
    stamp = folder_value(path, "run_stamp")
    found = F.when(stamp.isNotNull(), landed).otherwise(F.array(alone))
    return files.select(
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.coalesce(stamp, file_stamp(url_decoded(name))).alias("file_stamp"),
        F.inline(found),
    ).select(
        F.col("doc.document").alias("value"),
        F.col("id").alias("source_file"),
        "modified_at",
        F.col("doc.symbol").alias("symbol"),
        "file_stamp",
    )


def _repeats(m: Column) -> Column:
    return F.size(F.array_distinct(F.map_keys(m))) != F.size(m)


def _last_entries(m: Column) -> Column:
    """The entries of a JSON object. Of a name given twice, the last value counts."""
    entries, names = F.map_entries(m), F.map_keys(m)
    last = F.filter(
        entries,
        lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]),
    )
    return F.when(_repeats(m), last).otherwise(entries)


def _fields(m: Column) -> Column:
    return F.when(_repeats(m), F.map_from_entries(_last_entries(m))).otherwise(m)


def _bars(doc: Column) -> Column:
    """Every bar of a document as (ticker, date, fields), in document order."""
    return F.flatten(
        F.transform(
            _last_entries(doc),
            lambda t: F.transform(
                _last_entries(t["value"]),
                lambda d: F.struct(
                    t["key"].alias("ticker"),
                    d["key"].alias("date"),
                    _fields(d["value"]).alias("fields"),
                ),
            ),
        )
    )


def _lacks_field(bar: Column) -> Column:
    absent = bar["fields"].isNull()
    for name in BAR_FIELDS.values():
        absent = absent | ~F.map_contains_key(bar["fields"], name)
    return absent


def _too_long(bar: Column) -> Column:
    def over(value: Column, col: str) -> Column:
        return F.coalesce(F.char_length(value) > BRONZE_WIDTHS[col], F.lit(False))

    bad = over(bar["ticker"], "ticker") | over(bar["date"], "date")
    for col, name in BAR_FIELDS.items():
        bad = bad | over(bar["fields"][name], col)
    return bad


def _odd(bar: Column) -> Column:
    """Whether a bar may lack a field or hold one too long: cheap, and true of every bar of which that is so."""

    def fits(value: Column, col: str) -> Column:
        return F.coalesce(F.char_length(value) <= BRONZE_WIDTHS[col], F.lit(False))

    fit = fits(bar["ticker"], "ticker") & fits(bar["date"], "date")
    for col, name in BAR_FIELDS.items():
        fit = fit & fits(bar["fields"][name], col)
    return ~fit


def judge_files(files: DataFrame, value: str = "value") -> DataFrame:
    """Add ``bars`` (all bars of the file) and ``reason`` (NULL when acceptable)."""
    docs = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), _DOCUMENT, _STRICT_JSON)
    doc = F.col("docs")[0]
    no_object = F.col("docs").isNull() | (F.size("docs") != 1)
    bars = F.col("bars")
    reason = (
        F.when(F.col("doc").isNull(), F.lit(NOT_JSON))
        # A ticker without an object of dates leaves no list of bars at all.
        .when(bars.isNull(), F.lit(BAD_SHAPE))
        # Most documents are settled by a single look at each bar.
        .when(~F.exists(bars, _odd), F.lit(None))
        .when(F.exists(bars, _lacks_field), F.lit(MISSING_FIELD))
        .when(F.exists(bars, _too_long), F.lit(TOO_LONG))
    )
    return (
        files.withColumn("docs", docs)
        .withColumn("doc", F.when(~no_object, doc))
        .withColumn("bars", _bars(F.col("doc")))
        .withColumn("reason", reason)
        .drop("docs", "doc", value)
    )


def _bar_struct(bar: Column, pos: Column) -> Column:
    return F.struct(
        bar["ticker"].alias("ticker"),
        bar["date"].alias("date"),
        *[bar["fields"][name].alias(col) for col, name in BAR_FIELDS.items()],
        pos.cast("int").alias("file_pos"),
    )


def flatten_prices(files: DataFrame, value: str = "value") -> DataFrame:
    """One text row per bar of every acceptable document; other columns pass through."""
    keep = [c for c in files.columns if c != value]
    judged = judge_files(files, value)
    good = F.when(F.col("reason").isNull(), F.col("bars"))
    rows = F.transform(good, _bar_struct)
    return judged.select(*keep, F.inline(rows))


def split_valid_files(files: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(bars of the good files, rejected files with the reason)."""
    keep = [c for c in files.columns if c != value]
    rejected = judge_files(files, value).where("reason is not null").select(*keep, "reason")
    return flatten_prices(files, value), rejected


def bars_and_verdicts(files: DataFrame) -> DataFrame:
    """Both outcomes from a single parse: a ``file`` row per file plus its ``bar`` rows.

    Meant to be written partitioned by ``kind`` in one pass over the files.
    """
    judged = judge_files(files)
    n_bars = F.coalesce(F.size(F.when(F.col("reason").isNull(), F.col("bars"))), F.lit(0))
    empty = F.struct(
        F.lit(None).cast("string").alias("ticker"),
        F.lit(None).cast("string").alias("date"),
        *[F.lit(None).cast("string").alias(col) for col in BAR_FIELDS],
        F.lit(None).cast("int").alias("file_pos"),
    )

    def row(kind: str, bar: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), bar.alias("bar"))

    bars = F.when(
        F.col("reason").isNull(),
        F.transform(F.col("bars"), lambda b, i: row("bar", _bar_struct(b, i))),
    )
    rows = F.concat(F.array(row("file", empty)), F.coalesce(bars, F.array().cast(_ROWS)))
    meta = ["source_file", "modified_at", "symbol", "file_stamp"]
    # Each row gets a copy of every column that is kept beside the list, so the bars must not be one of them.
    counted = judged.select(
        *meta,
        F.when(F.col("reason").isNull(), F.lit("loaded")).otherwise(F.lit("rejected")).alias("status"),
        "reason",
        n_bars.alias("n_bars"),
        "bars",
    )
    return counted.select(*meta, "status", "reason", F.col("n_bars").alias("bars"), F.inline(rows)).select(
        *meta, "status", "reason", "bars", "kind", "bar.*"
    )


_ROWS = (
    "array<struct<kind:string,bar:struct<ticker:string,date:string,"
    + ",".join(f"{c}:string" for c in BAR_FIELDS)
    + ",file_pos:int>>>"
)


def write_raw(docs: DataFrame, path: str) -> None:
    """Land raw documents: a folder per run, a line per document.

    ``docs`` has ``symbol``, ``run_ts`` and the document text ``body``. A run that
    is landed again replaces what it had landed. Documents meet by run before the write, so
    there are as many files as runs, a big run more, and not a file per run and task.
    """
    landed = docs.select("symbol", F.col("body").alias("document"), run_stamp("run_ts").alias("run_stamp"))
    (
        landed.hint("rebalance", "run_stamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", DOCUMENTS_PER_FILE)
        .partitionBy("run_stamp")
        .json(path)
    )
