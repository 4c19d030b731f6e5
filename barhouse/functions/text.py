"""Text to value, and value to text.

All of these are built-in expressions, so they stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barhouse.schemas import PRICE

# How a run stamp is written, and how a price file is named.
RUN_STAMP_FORMAT = "yyyy-MM-dd_HH-mm-ss"
FILE_NAME = r"^(.*)_(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.[^.]*$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def decimal_or_null(c: Column | str) -> Column:
    """Price text to DECIMAL(11,4); NULL when it is no plain number or too large.

    Spark reads ``1e3`` as 1000, but a price with an exponent counts as bad here.
    """
    c = _col(c)
    return F.when(~F.lower(c).contains("e"), c.try_cast(PRICE))


def int_or_null(c: Column | str) -> Column:
    """Whole-number text to INT; NULL for fractions, junk and overflow."""
    return _col(c).try_cast("int")


def date_or_null(c: Column | str) -> Column:
    return _col(c).try_cast("date")


def contains_word(c: Column | str, word: str) -> Column:
    """Case-insensitive substring test."""
    return F.lower(_col(c)).contains(word.lower())


def run_stamp(c: Column | str) -> Column:
    return F.date_format(_col(c), RUN_STAMP_FORMAT)


def file_symbol(name: Column | str) -> Column:
    """The symbol in ``{symbol}_{stamp}.json``; NULL for any other name."""
    return F.nullif(F.regexp_extract(_col(name), FILE_NAME, 1), F.lit(""))


def file_stamp(name: Column | str) -> Column:
    """The run stamp in ``{symbol}_{stamp}.json``, as text that sorts by time."""
    return F.nullif(F.regexp_extract(_col(name), FILE_NAME, 2), F.lit(""))


def url_decoded(c: Column | str) -> Column:
    """Text of a file's address. A plus sign stands for itself there."""
    return F.url_decode(F.replace(_col(c), F.lit("+"), F.lit("%2B")))


def whole_seconds(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def folder_value(path: Column | str, key: str) -> Column:
    """The value of a ``key=value`` folder in a path; NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(path), f"/{key}=([^/]*)/", 1), F.lit(""))
