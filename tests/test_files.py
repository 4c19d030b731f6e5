"""Price documents: parse, accept or reject whole files, load, try again."""

from __future__ import annotations

import json
import os
import re
import shutil
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from barhouse.plans import loads
from barhouse.plans.loads import (
    BRONZE,
    FILES,
    bronze_current,
    compact_bronze,
    load_bronze,
    load_silver,
    retry_rejected,
)
from barhouse.sources import price_files
from barhouse.sources import (
    bars_and_verdicts,
    flatten_prices,
    judge_files,
    read_price_files,
    read_responses,
    split_valid_files,
    unwrap_daily,
    write_raw,
)
from barhouse.streaming import stream_bronze

GOOD = {"1. open": "1.0", "2. high": "2", "3. low": "0.5", "4. close": "1.50", "5. volume": "9"}


def doc(**tickers):
    return json.dumps(tickers, indent=4)


def without(field):
    return {k: v for k, v in GOOD.items() if k != field}


VERDICTS = [
    (doc(A={"2024-01-02": GOOD, "2024-01-03": GOOD}, B={"2024-01-02": GOOD}), None, 3),
    ("{}", None, 0),
    (doc(A={}), None, 0),
    (doc(A={"d": {**GOOD, "1. open": None}}), None, 1),
    (doc(A={"d": {**GOOD, "extra": "x" * 50}}), None, 1),
    (doc(A={"d": {**GOOD, "1. open": 1.25}}), None, 1),
    ('{"BAD": {', "not_json", 0),
    ("", "not_json", 0),
    ("[]", "not_json", 0),
    ("null", "not_json", 0),
    ("{} {}", "not_json", 0),
    ("{}, {}", "not_json", 0),
    ("{'A': {}}", "not_json", 0),
    (doc(A="text"), "not_json", 0),
    (doc(A={"d": "text"}), "not_json", 0),
    (doc(A=None), "bad_shape", 0),
    (doc(A={"d": None}), "missing_field", 0),
    *[(doc(A={"c": GOOD, "d": without(f)}), "missing_field", 0) for f in GOOD],
    *[(doc(A={"d": {**GOOD, f: "1" * 13}}), "too_long", 0) for f in GOOD],
    (doc(A={"d": {**GOOD, "1. open": "1" * 12}}), None, 1),
    (doc(A={"2024-01-02 00:00": GOOD}), "too_long", 0),
    (doc(THIRTEENCHARS={"d": GOOD}), "too_long", 0),
]


def test_verdicts(spark):
    files = spark.createDataFrame([(i, d) for i, (d, _, _) in enumerate(VERDICTS)], "i int, value string")
    reasons = dict(rows(judge_files(files), "i", "reason"))
    assert reasons == {i: reason for i, (_, reason, _) in enumerate(VERDICTS)}
    good, rejected = split_valid_files(files)
    found = Counter(r.i for r in good.collect())
    assert {i: found[i] for i in reasons} == {i: n for i, (_, _, n) in enumerate(VERDICTS)}
    assert {r.i for r in rejected.collect()} == {i for i, r in reasons.items() if r}


def test_values_stay_text(spark):
    files = spark.createDataFrame([(doc(A={"2024-01-02": GOOD}),)], "value string")
    row = flatten_prices(files).first()
    assert (row.ticker, row.date, row.open_price, row.close_price, row.volume) == (
        "A", "2024-01-02", "1.0", "1.50", "9",
    )


def test_load_rejects_bad_files_only(wh, land):
    land("A_2024-01-02_00-00-00.json", doc(A={"2024-01-02": GOOD, "2024-01-03": GOOD}))
    land("B_2024-01-02_00-00-00.json", doc(B={"2024-01-02": without("2. high"), "x": GOOD}))
    land("C_2024-01-02_00-00-00.json", '{"C": {')
    land("note.txt", "not listed")
    src = land("empty.json", "{}")
    result = load_bronze(wh, src)
    assert result.inserted == 2
    assert result.detail == "files loaded: 2, rejected: 2"
    assert rows(wh.table(BRONZE), "ticker", "date") == [("A", "2024-01-02"), ("A", "2024-01-03")]
    verdicts = rows(wh.table(FILES), "symbol", "file_stamp", "status", "reason", "bars")
    stamp = "2024-01-02_00-00-00"
    assert verdicts == [
        (None, None, "loaded", None, 0),
        ("A", stamp, "loaded", None, 2),
        ("B", stamp, "rejected", "missing_field", 0),
        ("C", stamp, "rejected", "not_json", 0),
    ]
    # Nothing is loaded twice; bad files are tried by every run and named by it.
    for _ in range(6):
        again = load_bronze(wh, src)
        assert again.inserted == 0
        assert rows(again.rejected.select(_name("source_file"), "reason")) == [
            ("B_2024-01-02_00-00-00.json", "missing_field"),
            ("C_2024-01-02_00-00-00.json", "not_json"),
        ]
    land("C_2024-01-02_00-00-00.json", doc(C={"2024-01-02": GOOD}))
    os.utime(os.path.join(src, "C_2024-01-02_00-00-00.json"), (2e9, 2e9))
    left = retry_rejected(wh, src, passes=2)
    assert rows(wh.table(BRONZE), "ticker").count(("C",)) == 1
    assert rows(left.select(_name("source_file"), "reason", "attempts")) == [
        ("B_2024-01-02_00-00-00.json", "missing_field", 9)
    ]


def _name(c):
    return F.regexp_extract(c, r"([^/]*)$", 1)


def test_loaded_then_rejected_is_named(wh, land):
    """A document that loaded once and is refused in a newer state is open until that one loads."""
    stamp = "2024-01-02_00-00-00"
    good, faulty = doc(A={"2024-01-02": GOOD}), "{"
    named = lambda: rows(loads.failed_files(wh).select(_name("source_file"), "reason"))

    def put(text, at, folder="", name=f"A_{stamp}.json"):
        src = land(folder + name, text)
        os.utime(os.path.join(src, folder + name), (at, at))
        load_bronze(wh, src)
        return src

    put(good, 1e9)
    assert named() == []
    src = put(faulty, 1.1e9)
    assert named() == [(f"A_{stamp}.json", "not_json")]
    assert retry_rejected(wh, src, passes=2).count() == 1
    put(good, 1.2e9)
    assert named() == []
    put(faulty, 0.9e9)  # an older file put back
    assert named() == [(f"A_{stamp}.json", "not_json")]
    put(good, 0.8e9)
    assert named() == []


def test_only_new_files_of_a_flat_folder_are_opened(wh, land, monkeypatch):
    for i in range(4):
        src = land(f"F{i}_2024-01-02_00-00-00.json", doc(**{f"T{i}": {"2024-01-02": GOOD}}))
    load_bronze(wh, src)
    opened = []
    real = loads.read_named_files
    monkeypatch.setattr(loads, "read_named_files", lambda s, paths: opened.extend(paths) or real(s, paths))
    land("F9_2024-01-02_00-00-00.json", doc(T9={"2024-01-02": GOOD}))
    assert load_bronze(wh, src).inserted == 1
    assert [p.rpartition("/")[2] for p in opened] == ["F9_2024-01-02_00-00-00.json"]
    assert load_bronze(wh, src).inserted == 0 and len(opened) == 1


@pytest.mark.parametrize("symbol", ["^GSPC", "BRK B", "A%41", "A+B", "X[1]", "{Y}*"])
def test_symbols_in_file_names(wh, land, symbol):
    src = land(f"{symbol}_2024-01-02_00-00-00.json", doc(**{symbol: {"2024-01-02": GOOD}}))
    assert load_bronze(wh, src).inserted == 1
    assert rows(wh.table(FILES), "symbol") == [(symbol,)]
    response = unwrap_daily(read_responses(wh.spark, src).withColumn("body", F.lit('{"Time Series (Daily)": {}}')))
    assert rows(response, "symbol", "body") == [(symbol, f'{{"{symbol}":{{}}}}')]
    assert load_bronze(wh, src).inserted == 0


def test_compaction_keeps_what_is_in_force(wh, land):
    for day, close in (("03", "3"), ("04", "4"), ("05", "5")):
        src = land(f"A_2024-01-{day}_00-00-00.json", doc(A={"2024-01-02": {**GOOD, "4. close": close}, f"2024-02-{day}": GOOD}))
        load_bronze(wh, src)
        if day == "04":
            load_silver(wh)
    before = rows(bronze_current(wh))
    compact_bronze(wh)
    # The version that the typed table has not read yet stays as it is.
    assert wh.row_count(BRONZE) == 5 and sum(p.rows > 0 for p in wh.parts(BRONZE)) == 2
    assert rows(bronze_current(wh)) == before
    assert load_silver(wh).updated == 1
    compact_bronze(wh)
    assert wh.row_count(BRONZE) == 4 and rows(bronze_current(wh)) == before
    assert wh.row_count(FILES) == 3
    assert wh.drop_superseded() > 0
    assert sum(p.rows for p in wh.parts(BRONZE)) == 4 and len(wh.parts(BRONZE)) == 1
    assert load_bronze(wh, src).inserted == 0
    assert load_silver(wh).inserted == 0


def test_same_content_again_moves_the_stamp_only(wh, land):
    land("r1/A_2024-01-02_00-00-00.json", doc(A={"2024-01-02": GOOD}))
    src = land("r1/B_2024-01-02_00-00-00.json", doc(B={"2024-01-02": GOOD}))
    load_bronze(wh, src)
    first = {r.ticker: r for r in bronze_current(wh).collect()}
    land("r2/A_2024-01-02_00-00-00.json", doc(A={"2024-01-02": GOOD}))
    assert load_bronze(wh, src).inserted == 1
    again = {r.ticker: r for r in bronze_current(wh).collect()}
    assert again["A"][:7] == first["A"][:7]
    assert again["A"].loaded_at > first["A"].loaded_at
    assert again["B"] == first["B"]


def test_newest_file_of_a_batch_wins(wh, land):
    land("A_2024-01-03_00-00-00.json", doc(A={"d": {**GOOD, "4. close": "new"}}))
    src = land("A_2024-01-02_00-00-00.json", doc(A={"d": {**GOOD, "4. close": "old"}}))
    load_bronze(wh, src)
    assert wh.row_count(BRONZE) == 2
    assert rows(bronze_current(wh), "close_price") == [("new",)]


def test_repeated_date_in_a_document_keeps_the_last(wh, land):
    text = '{"A": {"d": %s, "d": %s}}' % (
        json.dumps({**GOOD, "4. close": "1"}), json.dumps({**GOOD, "4. close": "2"})
    )
    load_bronze(wh, land("A.json", text))
    assert rows(bronze_current(wh), "close_price") == [("2",)]


def test_repeated_ticker_in_a_document_keeps_the_last(spark):
    bars = json.dumps({"d1": GOOD, "d2": GOOD}), json.dumps({"d3": GOOD})
    text = f'{{"A": {bars[0]}, "B": {bars[0]}, "A": {bars[1]}, "C": {{}}}}'
    out = flatten_prices(spark.createDataFrame([(text,)], "value string"))
    assert rows(out, "ticker", "date") == [("A", "d3"), ("B", "d1"), ("B", "d2")]


def test_repeated_names_inside_a_ticker_keep_the_last(spark):
    twice = json.dumps(GOOD)[:-1] + ', "1. open": "7"}'
    text = f'{{"A": {{"d1": {json.dumps(GOOD)}, "d2": {json.dumps(GOOD)}, "d1": {twice}}}}}'
    out = flatten_prices(spark.createDataFrame([(text,)], "value string"))
    assert rows(out, "date", "open_price", "close_price") == [("d1", "7", "1.50"), ("d2", "1.0", "1.50")]


def test_landing_layout_round_trip(spark, wh, tmp_path):
    landing = str(tmp_path / "raw")
    docs = spark.createDataFrame(
        [("A", doc(A={"2024-01-02": GOOD})), ("B/C", doc(B={"2024-01-02": GOOD}))],
        "symbol string, body string",
    ).withColumn("run_ts", F.lit("2024-01-05 01:02:03").cast("timestamp"))
    write_raw(docs, landing)
    write_raw(docs, landing)
    load_bronze(wh, landing)
    assert rows(wh.table(FILES), "symbol") == [("A",), ("B/C",)]
    assert rows(wh.table(BRONZE), "ticker", "file_stamp") == [
        ("A", "2024-01-05_01-02-03"), ("B", "2024-01-05_01-02-03"),
    ]
    later = docs.where("symbol = 'A'").withColumn("run_ts", F.lit("2024-01-06").cast("timestamp"))
    write_raw(later, landing)
    assert load_bronze(wh, landing).inserted == 1


def test_stream_loads_each_file_once(wh, land, tmp_path):
    checkpoint = str(tmp_path / "stream")
    src = land("A_2024-01-02_00-00-00.json", doc(A={"2024-01-02": GOOD}))
    land("bad.json", "{")

    def run():
        query = stream_bronze(wh, src, checkpoint)
        assert query.awaitTermination(120)
        assert query.exception() is None

    run()
    wh.refresh()
    assert rows(wh.table(BRONZE), "ticker", "file_stamp") == [("A", "2024-01-02_00-00-00")]
    land("B_2024-01-02_00-00-00.json", doc(B={"2024-01-02": GOOD}))
    run()
    wh.refresh()
    assert rows(wh.table(BRONZE), "ticker") == [("A",), ("B",)]
    assert rows(wh.table(FILES), "status") == [("loaded",), ("loaded",), ("rejected",)]


def test_stream_batch_repeated_after_a_crash_adds_nothing(wh, land, tmp_path):
    checkpoint = tmp_path / "stream"
    src = land("A.json", doc(A={"2024-01-02": GOOD}))
    stream_bronze(wh, src, str(checkpoint)).awaitTermination(120)
    wh.refresh()
    first = wh.table(BRONZE).first()
    # As if the process had died after the batch, before the stream noted its end.
    for leftover in (checkpoint / "commits").iterdir():
        leftover.unlink()
    stream_bronze(wh, src, str(checkpoint)).awaitTermination(120)
    wh.refresh()
    assert wh.row_count(BRONZE) == wh.row_count(FILES) == 1
    assert wh.table(BRONZE).first() == first


def test_stream_with_a_new_checkpoint_loses_and_repeats_nothing(wh, land, tmp_path):
    checkpoint, kept = tmp_path / "stream", tmp_path / "kept"
    src = land("A.json", doc(A={"2024-01-02": GOOD}))
    for name in ("B", "C"):
        stream_bronze(wh, src, str(checkpoint), archive=str(kept)).awaitTermination(120)
        shutil.rmtree(checkpoint)
        land(f"{name}.json", doc(**{name: {"2024-01-02": GOOD}}))
    stream_bronze(wh, src, str(checkpoint), archive=str(kept)).awaitTermination(120)
    wh.refresh()
    assert rows(wh.table(BRONZE), "ticker") == [("A",), ("B",), ("C",)]
    assert wh.row_count(FILES) == 3


@pytest.mark.parametrize("pieces", [1, 4])
def test_one_pass_writes_bars_and_verdicts(wh, land, pieces):
    for i in range(pieces):
        src = land(f"f{i}.json", doc(**{f"T{i}": {"2024-01-02": GOOD}}))
    assert load_bronze(wh, src).inserted == pieces
    assert wh.row_count(FILES) == pieces


def test_names_are_dealt_out_in_batches(wh, land, monkeypatch):
    from barhouse.plans import loads

    for i in range(12):
        src = land(f"S{i}_2024-01-0{1 + i % 9}_00-00-00.json", _DOC.replace("AAA", f"S{i}") if i else "{")
    monkeypatch.setattr(loads, "FILES_PER_BATCH", 4)
    given = []
    real = loads.read_named_files
    monkeypatch.setattr(loads, "read_named_files", lambda spark, paths: given.append(len(paths)) or real(spark, paths))
    result = loads.load_bronze(wh, src)
    assert len(given) > 1 and sum(given) == 12
    assert result.detail == "files loaded: 11, rejected: 1" and result.inserted == 11
    assert wh.row_count(loads.BRONZE) == 11 and wh.table(loads.FILES).count() == 12
    assert {r.ticker for r in wh.table(loads.BRONZE).collect()} == {f"S{i}" for i in range(1, 12)}
    given.clear()
    assert loads.load_bronze(wh, src).inserted == 0 and sum(given) == 1  # the rejected one is tried again


_DOC = (
    '{"AAA": {"2024-01-02": {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "2", "5. volume": "5"}}}'
)


def test_runs_are_landed_in_few_files(spark, tmp_path):
    """Tasks that hold documents of the same runs do not write a file each."""
    docs = spark.range(400).repartition(8).selectExpr(
        "concat('S', id) as symbol", "'{}' as body", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id % 20) as run_ts"
    )
    write_raw(docs, f"{tmp_path}/landed")
    assert len(list(tmp_path.glob("landed/run_stamp=*/*.json"))) == 20
    assert loads.read_named_files(spark, [f"{tmp_path}/landed"]).select("symbol").distinct().count() == 400


def test_no_row_carries_the_bars_of_its_document(wh, land):
    """A row of a document is made without the list of all its bars, which would grow with the square of these."""
    src = land("f.json", doc(A={f"2024-01-{day:02}": GOOD for day in range(1, 31)}))
    found = bars_and_verdicts(read_price_files(wh.spark, src))
    plan = found._jdf.queryExecution().executedPlan().toString()
    carried = re.search(r", \[([^\[\]]*)\], false, \[kind#", plan).group(1)
    assert "source_file#" in carried and re.search(r"transform\((bars#\d+)", plan).group(1) not in carried
    assert found.where("kind = 'bar'").count() == 30 and found.first().bars == 30


def test_a_single_look_finds_every_bar_that_may_be_bad(spark):
    fields = {"1. open": "1", "2. high": "2", "3. low": "1", "4. close": "1", "5. volume": "3"}
    lacking = {k: v for k, v in fields.items() if k != "3. low"}
    cases = {
        "fine": ({"A": {"2024-01-02": fields, "2024-01-03": fields}}, None),
        "none": ({"A": {}}, None),
        "null": ({"A": {"2024-01-02": {**fields, "3. low": None}}}, None),
        "lacking": ({"A": {"2024-01-02": fields, "2024-01-03": lacking}}, "missing_field"),
        "empty": ({"A": {"2024-01-02": None}}, "missing_field"),
        "long": ({"A": {"2024-01-02": {**fields, "5. volume": "1" * 13}}}, "too_long"),
        "name": ({"A" * 13: {"2024-01-02": fields}}, "too_long"),
        "day": ({"A": {"2024-01-02T00:00": fields}}, "too_long"),
        "both": ({"A": {"2024-01-02": {**fields, "5. volume": "1" * 13}, "2024-01-03": lacking}}, "missing_field"),
    }
    docs = spark.createDataFrame([(k, json.dumps(d)) for k, (d, _) in cases.items()], "name string, value string")
    judged = price_files.judge_files(docs).select("name", "reason", F.exists("bars", price_files._odd).alias("odd"))
    found = {r.name: r for r in judged.collect()}
    assert {k: r.reason for k, r in found.items()} == {k: reason for k, (_, reason) in cases.items()}
    # Only what holds a bad bar, or a NULL that is allowed, is looked at again.
    assert {k for k, r in found.items() if not r.odd} == {"fine", "none"}
