from __future__ import annotations

import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from barhouse.plans.warehouse import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("barhouse-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(folder / "catalog"))
        .config("spark.checkpoint.dir", str(folder / "checkpoint"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse")).create()


@pytest.fixture
def land(tmp_path):
    """Write a staged file below ``landing`` and return that folder."""
    folder = tmp_path / "landing"
    folder.mkdir()

    def write(name: str, text: str) -> str:
        target = folder / name
        target.parent.mkdir(exist_ok=True)
        target.write_text(text)
        return str(folder)

    return write


@pytest.fixture
def add_bronze(wh):
    """Append raw rows as one batch, past the files. Returns the load stamp."""
    from pyspark.sql import functions as F

    from barhouse.plans.loads import BRONZE
    from barhouse.plans.warehouse import at

    def add(rows, stamp: int | None = None) -> int:
        stamp = stamp or wh.next_stamp(BRONZE)
        schema = "ticker string, date string, open_price string, high_price string, " \
            "low_price string, close_price string, volume string"
        df = wh.spark.createDataFrame(rows, schema).coalesce(1)
        df = df.select(
            "*",
            at(stamp).alias("loaded_at"),
            F.lit("").alias("file_stamp"),
            F.lit("").alias("source_file"),
            F.lit(0).alias("file_pos"),
        )
        run = uuid.uuid4().hex
        wh.commit([wh.write_part(BRONZE, run, df, run, stamp)])
        return stamp

    return add


def bar(ticker="AAA", date="2024-01-02", o="10", h="12", low="9", c="11", v="100"):
    return (ticker, date, o, h, low, c, v)


def rows(df, *cols):
    """Sorted tuples of a small result."""
    out = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(out, key=lambda r: tuple((x is not None, str(x)) for x in r))
