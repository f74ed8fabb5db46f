"""Pages by a rank directory: the same rows as a sorted list's slices, and only the ranges that they need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from creditlake.operators import serve as S
from creditlake.operators.ranked import RANGE, store_ranked


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).select(((F.col("id") * 7919) % 10).alias("k"), F.col("id").cast("string").alias("v"), F.col("id"))


@pytest.fixture(scope="module")
def stored(rows):
    return store_ranked(rows, [F.desc("k"), F.asc("id")], ranges=8)


@pytest.fixture(scope="module")
def want(rows):
    return sorted((tuple(r) for r in rows.collect()), key=lambda r: (-r[0], r[2]))


@pytest.mark.parametrize("limit, offset", [(10, 0), (25, 137), (10, 995), (10, 1000), (1000, 0), (None, 0), (None, 990), (None, 2000), (300, 500)])
def test_pages_are_slices(stored, want, limit, offset):
    page = stored.page(limit=limit, offset=offset)
    assert [tuple(r) for r in page.collect()] == want[offset : None if limit is None else offset + limit]


def test_ranks_and_next_page(stored, want):
    page = stored.page(limit=5, offset=400, with_rank=True).collect()
    assert [r["_rank"] for r in page] == list(range(400, 405))
    assert [tuple(r) for r in stored.after(5, id=page[-1]["id"]).collect()] == want[405:410]
    assert stored.total() == 1000
    with pytest.raises(KeyError):
        stored.after(5, id=-1)


def test_only_the_needed_ranges_are_opened(spark, stored):
    page = stored.page(limit=5, offset=500)
    files = {f for f in page.inputFiles()}
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and RANGE in plan.split("PartitionFilters")[1].split("]")[0]
    assert files  # the scan itself
    rest = stored.page(offset=900)
    assert "SinglePartition" not in rest._jdf.queryExecution().executedPlan().toString()
    ranges = {r[0] for r in stored.rows().where(F.col("id").isin([x["id"] for x in page.collect()])).select(RANGE).distinct().collect()}
    assert len(ranges) <= 2


def test_offset_without_limit_of_a_mart(spark):
    mart = spark.createDataFrame([(f"o{i}", float(i % 3)) for i in range(30)], "org_id string, net_credit_balance double")
    want = [tuple(r) for r in S.finance_page(mart).collect()]
    got = S.finance_page(mart, offset=7)
    assert [tuple(r) for r in got.collect()] == want[7:]
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty(spark):
    empty = spark.createDataFrame([], "a long")
    assert store_ranked(empty, [F.asc("a")]).page(offset=3).collect() == []
