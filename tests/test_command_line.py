"""The whole way from saved responses to the fact table, by commands."""

from __future__ import annotations

import json
import logging

from conftest import rows

from barhouse.__main__ import run
from barhouse.plans.loads import FACT, RUN_LOG_TABLE
from barhouse.plans.warehouse import Warehouse

FIELDS = {"1. open": "1", "2. high": "2", "3. low": "3", "4. close": "4", "5. volume": "5"}


def test_all_jobs(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO, logger="barhouse")
    root, raw, landing, info = (str(tmp_path / d) for d in ("wh", "raw", "landing", "info"))
    for folder in (raw, info):
        (tmp_path / folder).mkdir()
    stamp = "2024-01-05_01-02-03"
    body = json.dumps({"Time Series (Daily)": {"2024-01-02": FIELDS}})
    (tmp_path / "raw" / f"AAA_{stamp}.json").write_text(body)
    (tmp_path / "raw" / f"ZZZ_{stamp}.json").write_text(body)
    (tmp_path / "raw" / f"BBB_{stamp}.json").write_text('{"Information": "1 request per second"}')
    names = ("Symbol", "Name", "Sector", "Industry", "Exchange", "Currency", "Country")
    company = {n: "AAA" for n in names}
    (tmp_path / "info" / f"AAA_{stamp}.json").write_text(json.dumps(company))

    assert run(spark, [root, "create"]) == 0
    assert run(spark, [root, "land", raw, landing]) == 0
    assert run(spark, [root, "bronze", landing]) == 0
    assert run(spark, [root, "silver"]) == 0
    assert run(spark, [root, "dim", info]) == 0
    assert run(spark, [root, "gold"]) == 0
    assert run(spark, [root, "quality"]) == 0
    wh = Warehouse(spark, root)
    assert rows(wh.table(FACT), "ticker_id", "volume") == [(1, 5)]
    runs = {r.job: r.detail for r in wh.table(RUN_LOG_TABLE).collect()}
    assert runs["land_prices"] == "ok: 2, rate_limited: 1"
    assert runs["load_gold"] == "tickers not in the dimension: 1"
    text = caplog.text
    assert "rate_limited: 1 (retry)" in text
    assert "price_inversion: 2" in text
    assert "changed: {'INSERT': 1}" in text
    assert run(spark, [root, "rebuild", "gold.fact_stock_prices"]) == 0
    assert run(spark, [root, "backfill"]) == 0
    assert run(spark, [root, "gold"]) == 0
    wh.refresh()
    assert wh.row_count(FACT) == 1
