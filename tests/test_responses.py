"""What a raw response means, and the documents inside."""

from __future__ import annotations

import json

import pytest
from conftest import rows

from barhouse.sources import classify_response, flatten_prices, parse_company, unwrap_daily

RULES = [
    ("<html>", "transport_error", True),
    (None, "transport_error", True),
    ("", "transport_error", True),
    ('{"Error Message": "the API key is invalid"}', "invalid_key", False),
    ('{"Error Message": "unknown Symbol"}', "invalid_symbol", False),
    ('{"Error Message": "the api key or symbol is wrong"}', "invalid_key", False),
    ('{"Error Message": "other"}', "unrecognized_error", False),
    ('{"Error Message": "x", "Information": "remove"}', "unrecognized_error", False),
    ('{"Information": "... to Remove the daily limit of 1 request"}', "daily_quota", False),
    ('{"Information": "1 Request per second"}', "rate_limited", True),
    ('{"Information": "other", "Name": "n"}', "unrecognized_info", False),
    ("{}", "unknown", True),
    ("[1]", "unknown", True),
]
BY_KIND = [
    ("prices", '{"Time Series (Daily)": {}}', "ok"),
    ("prices", '{"Name": "n"}', "unknown"),
    ("company", '{"Name": "n"}', "ok"),
    ("company", '{"Time Series (Daily)": {}}', "unknown"),
]


@pytest.mark.parametrize("kind", ["prices", "company"])
def test_rules(spark, kind):
    df = spark.createDataFrame([(i, b) for i, (b, _, _) in enumerate(RULES)], "i int, body string")
    out = classify_response(df, kind)
    assert {r.i: (r.outcome, r.retryable) for r in out.collect()} == {
        i: (o, retry) for i, (_, o, retry) in enumerate(RULES)
    }


def test_success_depends_on_the_kind(spark):
    df = spark.createDataFrame([(k, b) for k, b, _ in BY_KIND], "kind string, body string")
    out = {(r.kind, r.body): r.outcome for r in classify_response(df).collect()}
    assert out == {(k, b): o for k, b, o in BY_KIND}


def test_unwrap_keys_by_the_requested_symbol(spark):
    fields = {"1. open": "1.10", "2. high": "2", "3. low": "1", "4. close": "1", "5. volume": "3"}
    body = json.dumps({"Meta Data": {}, "Time Series (Daily)": {"2024-01-02": fields}})
    df = spark.createDataFrame([('A"B', body), ("C", "{}")], "symbol string, body string")
    out = unwrap_daily(df)
    assert json.loads(out.first().body) == {'A"B': {"2024-01-02": fields}}
    bars = flatten_prices(out, "body")
    assert rows(bars, "ticker", "date", "open_price") == [('A"B', "2024-01-02", "1.10")]


def test_company(spark):
    doc = {"Symbol": "A", "Name": "A Inc", "Sector": "S", "Exchange": None, "Other": {"x": 1}}
    df = spark.createDataFrame([("A", json.dumps(doc)), ("B", "{}")], "symbol string, body string")
    assert rows(parse_company(df), "ticker", "company_name", "sector", "industry", "exchange") == [
        ("A", "A Inc", "S", None, None)
    ]
