"""Which tickers are proposed as new names of old ones."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from barhouse.operators import rename_candidates
from barhouse.operators.renames import chains, rename_pairs
from barhouse.plans import given as g
from barhouse.plans.scratch import materialise

SCHEMA = "ticker string, date date, open_price decimal(11,4), high_price decimal(11,4), " \
    "low_price decimal(11,4), close_price decimal(11,4), volume int"


def bars_of(ticker, days, base=10, volume=5):
    return [
        (ticker, dt.date(2024, 1, d), *[Decimal(base * 100 + d + i) for i in range(4)], volume + d) for d in days
    ]


def dim_of(spark, *tickers):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(tickers)], "ticker_id int, ticker string")


def found(spark, data, *known, **options):
    bars = spark.createDataFrame(data, SCHEMA)
    return sorted(tuple(r) for r in rename_candidates(bars, dim_of(spark, *known), materialise, **options).collect())


def test_one_rename(spark):
    data = bars_of("OLD", range(1, 8)) + bars_of("NEW", range(3, 15)) + bars_of("OTHER", range(1, 15), base=20)
    assert found(spark, data, "OLD", "OTHER") == [(1, "OLD", "NEW", 5, 1.0, "NEW", 1)]


def test_what_is_no_rename(spark):
    old = bars_of("OLD", range(1, 8))
    assert found(spark, old + bars_of("NEW", range(1, 15)), "OLD", "NEW") == []  # both are known
    assert found(spark, bars_of("OLD", range(1, 15)) + bars_of("NEW", range(1, 15)), "OLD") == []  # it goes on
    assert found(spark, old + bars_of("NEW", range(6, 15)), "OLD") == []  # two common days
    apart = bars_of("NEW", range(1, 4)) + bars_of("NEW", range(4, 15), base=30)
    assert found(spark, old + apart, "OLD") == []  # three of seven days agree
    assert found(spark, old + apart, "OLD", least_agreement=0.4) == [(1, "OLD", "NEW", 7, 3 / 7, "NEW", 1)]
    assert found(spark, [], "OLD") == []


def test_bars_that_many_share_bring_nobody_together(spark):
    data = []
    for i in range(30):
        data += bars_of(f"T{i}", range(1, 8 if i < 15 else 15))
    known = [f"T{i}" for i in range(15)]
    assert found(spark, data, *known) == []
    bars = spark.createDataFrame(data, SCHEMA)
    assert rename_pairs(bars, dim_of(spark, *known), 8, materialise).count() == 0
    assert rename_pairs(bars, dim_of(spark, *known), 30, materialise).count() == 15 * 15


def test_bars_without_all_values_are_no_evidence(spark):
    blank = [(t, dt.date(2024, 1, d), None, None, None, None, 0) for t, n in (("OLD", 7), ("NEW", 14)) for d in range(1, n)]
    assert found(spark, blank, "OLD") == []


def test_chains(spark):
    data = bars_of("A", range(1, 6)) + bars_of("B", range(1, 10)) + bars_of("C", range(1, 14)) + bars_of("D", range(1, 18))
    assert found(spark, data, "A") == [(1, "A", "B", 5, 1.0, "D", 3)]
    links = [(f"t{i:02d}", f"t{i + 1:02d}") for i in range(37)] + [("x", "t30")]
    ends = chains(spark.createDataFrame(links, "ticker string, new_ticker string"), materialise).collect()
    assert {(r.ticker, r.steps) for r in ends} == {(f"t{i:02d}", 37 - i) for i in range(37)} | {("x", 8)}
    assert {r.current_ticker for r in ends} == {"t37"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_planted_renames_are_found(spark, sf):
    folder = f"/root/testdata/{sf}"
    bars, dim = g.renamed_bars(spark, folder), g.dim(spark, folder)
    rows = {r.ticker: r for r in rename_candidates(bars, dim, materialise).collect()}
    last = {r.ticker for r in bars.select("ticker").distinct().collect()}
    planted = {t for t in (r.ticker for r in dim.select("ticker").collect()) if t in last and int(t[1:]) % 7 == 0}
    hit = {
        t for t in planted
        if t in rows and rows[t].new_ticker == "R" + t[1:] and rows[t].current_ticker == ("RS"[int(t[1:]) % 21 == 0] + t[1:])
    }
    assert planted and len(hit) / len(planted) >= 0.9
    assert set(rows) <= planted
