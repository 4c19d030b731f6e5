"""Bars of given tickers, opening only the parts and row groups that can hold them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barhouse.plans.warehouse import Warehouse

#: Up to so many tickers are handed to the scan as a filter; more are joined.
MOST_PUSHED = 1000
#: Values of one IN that Spark hands to parquet as they are; of longer lists it keeps the range only.
_IN_LIST = 10


def one_of(column: str, values: list) -> Column:
    """``column`` is one of the values, in a form that reaches the row groups' bloom filters and dictionaries."""
    lists = [values[i : i + _IN_LIST] for i in range(0, len(values), _IN_LIST)]
    return reduce(or_, [F.col(column).isin(*x) for x in lists], F.lit(False)) if lists else F.lit(False)


def key_lookup(wh: Warehouse, table: str, keys: DataFrame, column: str = "ticker") -> DataFrame:
    """The rows of a table that match ``keys``: a ticker (or id) column, and a ``date`` where days are given too.

    Files are sorted by the key and have a bloom filter of it per row group (see ``Warehouse.write_periods``).
    Few keys become a filter of the scan, which skips row groups by range, dictionary and bloom filter; beyond
    ``MOST_PUSHED`` the keys are joined, and Spark decides by their size how. With days, only their periods are
    opened. NULL keys match nothing; keys that repeat count once.
    """
    on = [c for c in (column, "date") if c in keys.columns]
    wanted = keys.select(*on).dropna().distinct()
    periods = None
    if "date" in on:
        periods = [r.period for r in wanted.select(wh.period_of()).distinct().collect()]
    rows = wh.table(table, periods)
    few = [r[0] for r in wanted.select(column).distinct().limit(MOST_PUSHED + 1).collect()]
    if len(few) <= MOST_PUSHED:
        rows = rows.where(one_of(column, sorted(few)))
        if on == [column]:
            return rows
    return rows.join(wanted, on, "left_semi")
