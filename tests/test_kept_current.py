"""Stored figures and quality counts follow corrections without reading the rest; the typed stream."""

from __future__ import annotations

import datetime as dt
import random
import shutil

import pytest
from conftest import bar, rows
from pyspark.sql import functions as F

from barhouse.plans import loads, quality
from barhouse.plans.derived import COUNTS, DERIVED, derived_figures, load_derived, needed_periods, rebuild_derived
from barhouse.plans.loads import SILVER, load_silver
from barhouse.plans.repair import repair_silver
from barhouse.plans.warehouse import Warehouse
from barhouse.schemas import BAR_KEYS
from barhouse.streaming import stream_silver


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), "day").create()


@pytest.fixture
def read(monkeypatch):
    """The parts of each table that are opened."""
    seen = []
    real = Warehouse.read

    def spy(self, name, parts):
        parts = list(parts)
        seen.append((name, {p.name for p in parts if p.rows}))
        return real(self, name, parts)

    monkeypatch.setattr(Warehouse, "read", spy)
    return lambda name: set().union(*[days for n, days in seen if n == name]), seen


def day(n):
    return (dt.date(2024, 1, 1) + dt.timedelta(n)).isoformat()


def figures(df):
    return rows(df.select("ticker", "date", "close_price", "change", "pct_change", F.round("moving_average", 9)))


def test_figures_follow_random_deliveries(wh, add_bronze):
    """Gaps, corrections, late first bars and new tickers: always as if computed anew."""
    rng = random.Random(7)
    for _ in range(4):
        bars = {(f"T{rng.randrange(5)}", rng.randrange(25)) for _ in range(rng.randrange(1, 25))}
        add_bronze([bar(t, day(d), c=str(rng.randrange(1, 50))) for t, d in bars])
        load_silver(wh)
        load_derived(wh)
        assert figures(wh.table(DERIVED)) == figures(derived_figures(wh.table(SILVER)))


def test_a_correction_opens_only_the_days_it_needs(wh, add_bronze, read):
    days_read, seen = read
    add_bronze([bar(t, day(d), c=str(10 + d)) for t in ("A", "B") for d in range(20)])
    load_silver(wh)
    load_derived(wh)
    before = {p.name: p.path for p in wh.parts(DERIVED)}
    add_bronze([bar("A", day(8), c="99")])
    load_silver(wh)
    seen.clear()
    result = load_derived(wh)
    touched = {day(d) for d in range(8, 13)}
    # The bar, the four after it, and the four before it that their averages need.
    assert days_read(SILVER) == {day(d) for d in range(4, 13)}
    assert days_read(DERIVED) == touched
    assert {p.name for p in wh.parts(DERIVED) if before[p.name] != p.path} == touched
    assert result.detail == "bars changed: 1, figures computed: 5" and result.updated == 5
    assert figures(wh.table(DERIVED)) == figures(derived_figures(wh.table(SILVER)))
    assert load_derived(wh).updated == 0


def test_rebuilt_figures(wh, add_bronze):
    add_bronze([bar("A", day(d), c=str(10 + d)) for d in range(8)])
    load_silver(wh)
    load_derived(wh)
    rebuild_derived(wh, 3)
    assert wh.row_count(DERIVED) == 8 and wh.row_count(COUNTS) == 8
    assert figures(wh.table(DERIVED)) == figures(derived_figures(wh.table(SILVER), 3))


def test_needed_periods_are_told_by_counts(spark):
    counts = [("A", f"p{i:02d}", n) for i, n in enumerate([9, 1, 1, 1, 0 + 2, 7, 3, 1, 8, 8])] + [("B", "p04", 3)]
    counts = spark.createDataFrame(counts, "ticker string, period string, bars int")
    changed = spark.createDataFrame([("A", "p04")], "ticker string, period string")
    found = {r.period: r.affected for r in needed_periods(counts, changed, 4).collect()}
    # Touched: p04 itself and p05, whose first bars are next. Needed: four bars before p04.
    assert found == {"p00": False, "p01": False, "p02": False, "p03": False, "p04": True, "p05": True}


def test_quality_reads_only_new_parts(wh, add_bronze, read):
    days_read, seen = read

    def check(days):
        seen.clear()
        counts = quality.quality_counts(wh)
        assert days_read(SILVER) == days
        want = {r.report: r.row_count for r in loads.report_counts(wh.table(SILVER)).collect()}
        assert counts == want
        return counts

    assert check(set()) == {"price_inversion": 0, "negative_value": 0, "zero_value": 0}
    add_bronze([bar("A", day(d), h="1", low="2") for d in range(6)] + [bar("B", day(1), v="0")])
    load_silver(wh)
    assert check({day(d) for d in range(6)})["price_inversion"] == 6
    assert check(set())["zero_value"] == 1
    add_bronze([bar("A", day(2), c="-4"), bar("C", day(9))])
    load_silver(wh)
    assert check({day(2), day(9)}) == {"price_inversion": 5, "negative_value": 1, "zero_value": 1}
    wh.rebuild(SILVER)
    assert check(set())["zero_value"] == 0


def test_quality_summaries_are_merged(wh, add_bronze, monkeypatch):
    monkeypatch.setattr(quality, "MERGE_AT", 3)
    for d in range(5):
        add_bronze([bar("A", day(d), v="0")])
        load_silver(wh)
        assert quality.quality_counts(wh)["zero_value"] == d + 1
    assert len([p for p in wh.parts(quality.QUALITY) if p.rows]) < 4


def document(**closes):
    body = ", ".join(
        f'"{d}": {{"1. open": "1", "2. high": "9", "3. low": "1", "4. close": "{c}", "5. volume": "5"}}'
        for d, c in closes.items()
    )
    return '{"A": {%s}}' % body


def closes(wh):
    return {r.date.isoformat(): int(r.close_price) for r in wh.table(SILVER).collect()}


def test_stream_keeps_the_newest_version(wh, land, tmp_path):
    checkpoint = str(tmp_path / "typed_stream")

    def run(name, **bars):
        src = land(name, document(**{f"2024-01-{k[1:]}": v for k, v in bars.items()}))
        stream_silver(wh, src, checkpoint, lateness="10 days").awaitTermination(120)
        wh.refresh()
        return closes(wh)

    assert run("A_2024-02-02_00-00-00.json", d02=20, d03=30) == {"2024-01-02": 20, "2024-01-03": 30}
    # A correction, and a file of an older run that comes last.
    assert run("A_2024-02-03_00-00-00.json", d03=33, d04=44) == {"2024-01-02": 20, "2024-01-03": 33, "2024-01-04": 44}
    assert run("A_2024-02-01_00-00-00.json", d01=1, d03=3) == {
        "2024-01-01": 1, "2024-01-02": 20, "2024-01-03": 33, "2024-01-04": 44,
    }
    # Nothing new, and a new checkpoint over the same files.
    parts = wh.parts(SILVER)
    stream_silver(wh, str(tmp_path / "landing"), checkpoint).awaitTermination(120)
    wh.refresh()
    assert wh.parts(SILVER) == parts
    shutil.rmtree(checkpoint)
    stream_silver(wh, str(tmp_path / "landing"), checkpoint).awaitTermination(120)
    wh.refresh()
    assert closes(wh)["2024-01-03"] == 33


def test_bars_beyond_the_watermark_are_found_by_the_repair(wh, land, tmp_path):
    checkpoint = str(tmp_path / "typed_stream")
    for name, bars in (("A_2024-02-01_00-00-00.json", {"2024-01-30": 30}), ("A_2024-02-02_00-00-00.json", {"2024-01-31": 31}),
                       ("A_2024-02-03_00-00-00.json", {"2024-01-02": 2})):
        src = land(name, document(**bars))
        stream_silver(wh, src, checkpoint, lateness="5 days").awaitTermination(120)
    wh.refresh()
    assert closes(wh) == {"2024-01-30": 30, "2024-01-31": 31}
    loads.load_bronze(wh, src)
    load_silver(wh)
    assert closes(wh) == {"2024-01-02": 2, "2024-01-30": 30, "2024-01-31": 31}
    assert repair_silver(wh).detail is None


def test_a_part_of_the_counts_is_one_file(spark, wh, add_bronze):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        add_bronze([bar(f"T{i:02d}", f"2024-01-{d:02d}") for i in range(40) for d in range(2, 6)])
        load_silver(wh)
        load_derived(wh)
    finally:
        spark.conf.unset(setting)
    files = wh.table(COUNTS).select("period", "_metadata.file_path").distinct()
    assert {r.period: r["count"] for r in files.groupBy("period").count().collect()} == {f"2024-01-{d:02d}": 1 for d in range(2, 6)}
    assert rows(wh.table(DERIVED), *BAR_KEYS) == rows(wh.table(SILVER), *BAR_KEYS)
