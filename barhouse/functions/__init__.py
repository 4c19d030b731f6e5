"""Column-level helpers."""

from barhouse.functions.text import (
    RUN_STAMP_FORMAT,
    contains_word,
    date_or_null,
    decimal_or_null,
    file_stamp,
    file_symbol,
    folder_value,
    int_or_null,
    run_stamp,
    url_decoded,
    whole_seconds,
)

__all__ = [
    "RUN_STAMP_FORMAT",
    "contains_word",
    "date_or_null",
    "decimal_or_null",
    "file_stamp",
    "file_symbol",
    "folder_value",
    "int_or_null",
    "run_stamp",
    "url_decoded",
    "whole_seconds",
]
