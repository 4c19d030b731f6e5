"""Reading and landing raw documents."""

from barhouse.sources.price_files import (
    bars_and_verdicts,
    flatten_prices,
    judge_files,
    file_of,
    list_price_files,
    read_named_files,
    read_price_files,
    split_valid_files,
    with_provenance,
    write_raw,
)
from barhouse.sources.responses import (
    classify_response,
    company_problem,
    parse_company,
    read_responses,
    unwrap_daily,
    with_document,
)

__all__ = [
    "bars_and_verdicts",
    "classify_response",
    "company_problem",
    "flatten_prices",
    "judge_files",
    "file_of",
    "list_price_files",
    "read_named_files",
    "parse_company",
    "read_price_files",
    "read_responses",
    "split_valid_files",
    "unwrap_daily",
    "with_document",
    "with_provenance",
    "write_raw",
]
