"""What the plans of the registered queries may and may not contain."""

from __future__ import annotations

import re

import pytest
from test_oracles import SF_DIR

import __spark_entry__ as contract


def plan_of(spark, name):
    df = contract.queries()[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", contract.QUERIES)
def test_no_all_pairs_and_no_python(spark, name):
    plan = plan_of(spark, name)
    for word in ("NestedLoop", "Cartesian", "Python", "Pandas", "Rdd", "ExistingRDD"):
        assert word not in plan, word


def test_merge_needs_no_outer_join(spark):
    plan = plan_of(spark, "upsert_state")
    assert "LeftAnti" in plan and "FullOuter" not in plan


def test_scans_read_only_what_they_need(spark):
    columns = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(spark, "pk_violations")).group(1)
    assert sorted(c.split(":")[0] for c in columns.split(",")) == ["l_linenumber", "l_orderkey"]


@pytest.mark.parametrize("name", ["bronze_current", "newest_typed", "pk_violations", "merge_actions"])
def test_groups_are_reduced_before_the_shuffle(spark, name):
    assert "partial_" in plan_of(spark, name)


def test_each_report_is_one_scan(spark):
    assert plan_of(spark, "dq_counts").count("FileScan") == 1
    assert plan_of(spark, "cast_failures").count("FileScan") == 1
