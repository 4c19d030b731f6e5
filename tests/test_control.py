"""The control table."""

from __future__ import annotations

import datetime as dt

from conftest import rows

from barhouse.operators import advance_marks, read_marks, reset_marks, seed_marks

SEED, T1, T2, T3 = (dt.datetime(y, 1, 1) for y in (2000, 2024, 2025, 2026))
CONTROL = "procedure_name string, last_run timestamp, high_mark timestamp"


def _names(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "procedure_name string")


def test_seed_read_advance_reset(spark):
    control = spark.createDataFrame([("a", T2, T1)], CONTROL)
    healed = seed_marks(control, _names(spark, "a", "b"))
    assert rows(healed) == [("a", T2, T1), ("b", SEED, SEED)]
    assert rows(seed_marks(healed, _names(spark, "a", "b"))) == rows(healed)
    assert rows(read_marks(control, _names(spark, "a", "x"))) == [("a", T2, T1), ("x", None, None)]

    runs = spark.createDataFrame([("a", T3, None), ("b", T3, T2), ("x", T3, T3)], CONTROL)
    moved = advance_marks(healed, runs)
    # An empty run keeps its mark, and a load without a control row stays without one.
    assert rows(moved) == [("a", T3, T1), ("b", T3, T2)]
    assert rows(reset_marks(moved, _names(spark, "b", "x"))) == [("a", T3, T1), ("b", SEED, SEED)]
