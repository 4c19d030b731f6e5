"""DataFrame in, DataFrame out: the relational steps of the warehouse."""

from barhouse.operators.control import advance_marks, read_marks, reset_marks, seed_marks
from barhouse.operators.derived import day_over_day, moving_average, price_range
from barhouse.operators.dimension import (
    dim_upsert,
    has_missing,
    listed,
    missing_facts,
    missing_tickers,
    new_tickers,
    resolve_ticker,
    unmatched_tickers,
)
from barhouse.operators.incremental import cast_prices, incremental, typed_source
from barhouse.operators.keys import (
    assign_keys,
    check_fk,
    check_not_null,
    check_unique,
    check_widths,
    too_wide,
)
from barhouse.operators.merge import count_actions, latest, merge_actions, merge_upsert
from barhouse.operators.quality import (
    cast_failures,
    quality_details,
    negative_values,
    price_inversions,
    report_counts,
    zero_values,
)
from barhouse.operators.renames import rename_candidates

__all__ = [
    "advance_marks",
    "assign_keys",
    "cast_failures",
    "cast_prices",
    "check_fk",
    "check_not_null",
    "check_unique",
    "check_widths",
    "count_actions",
    "day_over_day",
    "dim_upsert",
    "quality_details",
    "has_missing",
    "incremental",
    "latest",
    "listed",
    "merge_actions",
    "merge_upsert",
    "missing_facts",
    "missing_tickers",
    "moving_average",
    "negative_values",
    "new_tickers",
    "price_inversions",
    "price_range",
    "read_marks",
    "rename_candidates",
    "report_counts",
    "reset_marks",
    "resolve_ticker",
    "seed_marks",
    "too_wide",
    "typed_source",
    "unmatched_tickers",
    "zero_values",
]
