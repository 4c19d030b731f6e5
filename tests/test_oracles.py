"""Every registered query equals its SQL on the given tables."""

from __future__ import annotations

import datetime as dt
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    return con


def _comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v):
        if isinstance(v, float):
            return f"{v:.9g}"
        return v.isoformat() if isinstance(v, dt.datetime) else repr(v)

    return sorted(columns), sorted(tuple(text(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_equals_sql(spark, db, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = _comparable(df.columns, [tuple(r) for r in df.collect()])
    cursor = db.execute(contract.oracle_sql()[name])
    want = _comparable([d[0] for d in cursor.description], cursor.fetchall())
    assert got == want
    assert got[1], "the query should find something"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["ticker", "date", "close_price"]
    assert not df.isEmpty()
