"""Plan-shape guards: the scale properties the README claims, checked on real plans."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from creditlake.operators import marts as M
from conftest import SF_SMALL, fact_rows

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_no_python_and_no_sort_merge_join(spark, name):
    plan = _plan(entry.QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas"):
        assert node not in plan
    assert "SortMergeJoin" not in plan


def test_cleaning_never_shuffles_the_raw_rows(spark):
    plan = _plan(entry.QUERIES["clean_user_actions"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_first_org_hashes_the_raw_rows(spark):
    """The only sort-based aggregate is over one row a user and organisation."""
    plan = _plan(entry.QUERIES["first_org_per_user"](spark, SF_SMALL))
    below = plan[plan.index("HashAggregate(keys=[user_id") :]
    assert "min(" in below and "SortAggregate" not in below
    assert "Sort [" not in below


def test_executive_mart_expands_nothing(spark):
    """The fact is read in the stored stage only, and no row is multiplied for distinct counts."""
    plan = _plan(entry.QUERIES["executive_summary"](spark, SF_SMALL))
    assert "orders.parquet" not in plan and "Expand" not in plan


def test_marts_on_a_stored_rollup_push_the_filter_into_the_scan(spark, scratch):
    rows = [
        ("o1", "u1", "t", "add", 1.0, "2024-01-01"),
        ("o1", "u2", "default", "add", 1.0, "2024-01-02"),
    ]
    path = os.path.join(scratch, "rollup_pushdown")
    M.daily_rollup(fact_rows(spark, rows)).write.mode("overwrite").parquet(path)
    rollup = spark.read.parquet(path)
    key = "spark.sql.maxMetadataStringLength"
    saved = spark.conf.get(key)
    spark.conf.set(key, "2000")  # print scan metadata untruncated
    try:
        plan = _plan(M.cs_daily_activity(rollup, rolled_up=True))
    finally:
        spark.conf.set(key, saved)
    assert "Not(EqualTo(credit_type,default))" in plan.split("PushedFilters")[1]
    assert "n_amount" not in plan.split("ReadSchema")[1].split("\n")[0]  # unused column pruned
