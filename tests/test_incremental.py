"""Replaced and added days enter the stored states; the marts equal a full rebuild."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from creditlake.plans.incremental import incremental_marts
from creditlake.plans.publish import build_marts
from conftest import ORGS_DDL, USERS_DDL, fact_rows

AS_OF = "2024-02-01"
DAYS = [f"2024-01-{d:02d}" for d in range(1, 13)]


def random_rows(rng, days, n):
    rows = []
    for _ in range(n):
        org = rng.choice(["o1", "o1", "o1", "o2", "o3", "lost"])
        user = rng.choice(["u1", "u2", "u3", "stray"])
        ctype = rng.choice(["t", "s", "default", None])
        action = rng.choice(["add", "deduct", "other", None])
        credits = rng.choice([1.0, 2.5, 0.0001, -3.0, 7.123456, None])
        rows.append((org, user, ctype, action, credits, rng.choice(days)))
    return rows


def dimensions(spark):
    orgs = [("o1", "One", "Tech"), ("o2", "Same", "Tech"), ("o3", "Same", "Tech"), ("o4", "Idle", None)]
    users = [("u1", "Ann", "a@x", "o1", "admin"), ("u2", "Bob", "b@x", "o2", None), ("u3", "Ann", "c@x", "o1", "user")]
    return spark.createDataFrame(orgs, ORGS_DDL), spark.createDataFrame(users, USERS_DDL)


def listed(df):
    rounded = [round(v, 6) if isinstance(v, float) else v for r in df.select(sorted(df.columns)).collect() for v in r]
    width = len(df.columns)
    return sorted((rounded[k : k + width] for k in range(0, len(rounded), width)), key=repr)


def assert_as_rebuilt(spark, store, rows):
    orgs, users = dimensions(spark)
    full = build_marts(fact_rows(spark, rows), orgs, users, AS_OF)
    for name, mart in store.marts(orgs, users, AS_OF).items():
        assert listed(mart) == listed(full[name]), name


@pytest.mark.parametrize("period", ["day", "month"])
def test_equals_a_full_rebuild_after_replaced_added_and_emptied_days(spark, period):
    rng = random.Random(3)
    store = incremental_marts(spark, parts=3, period=period)
    assert store.version() == 0 and store.state().count() == 0
    rows = random_rows(rng, DAYS[:8], 160) + [("o1", "u1", "t", "add", 5.0, None)]
    assert store.refresh(fact_rows(spark, rows)) == 1
    assert_as_rebuilt(spark, store, rows)
    before = rows
    # Days 7 and 8 replaced, 9 to 12 added, the NULL day replaced, day 1 emptied.
    changed = random_rows(rng, DAYS[6:], 90) + [("o2", "u2", "s", "deduct", 1.0, None)]
    gone = {DAYS[0], None, *(r[5] for r in changed)}
    rows = [r for r in rows if r[5] not in gone] + changed
    assert store.refresh(fact_rows(spark, changed), days=[dt.date(2024, 1, 1)]) == 2
    assert_as_rebuilt(spark, store, rows)
    # The version before it is still whole.
    orgs, _ = dimensions(spark)
    old = store.marts(*dimensions(spark), AS_OF, version=1)["enhanced_finance_view"]
    assert listed(old) == listed(build_marts(fact_rows(spark, before), *dimensions(spark), AS_OF)["enhanced_finance_view"])


def test_nan_leaves_with_its_day(spark):
    store = incremental_marts(spark, parts=2)
    rows = [("o1", "u1", "t", "add", float("nan"), DAYS[0]), ("o1", "u1", "t", "add", 2.0, DAYS[1])]
    store.refresh(fact_rows(spark, rows))
    rows = [("o1", "u1", "t", "add", 1.0, DAYS[0]), rows[1]]
    store.refresh(fact_rows(spark, rows[:1]))
    assert_as_rebuilt(spark, store, rows)


def test_empty_refreshes(spark):
    store = incremental_marts(spark, parts=2)
    assert store.refresh(fact_rows(spark, [])) == 1
    rows = random_rows(random.Random(4), DAYS[:3], 20)
    store.refresh(fact_rows(spark, rows))
    assert store.refresh(fact_rows(spark, [])) == 3  # touches nothing
    assert_as_rebuilt(spark, store, rows)
    store.refresh(fact_rows(spark, []), days=[dt.date.fromisoformat(d) for d in DAYS])
    assert store.state().count() == 0 and store.days().count() == 0


def test_a_failed_refresh_changes_nothing(spark, monkeypatch):
    store = incremental_marts(spark, parts=2)
    rows = random_rows(random.Random(5), DAYS[:4], 30)
    store.refresh(fact_rows(spark, rows))
    real = type(store)._write

    def failing(self, df, table, *rest):
        if table == "state":
            raise RuntimeError("lost")
        real(self, df, table, *rest)

    monkeypatch.setattr(type(store), "_write", failing)
    changed = random_rows(random.Random(6), DAYS[2:6], 30)
    with pytest.raises(RuntimeError):
        store.refresh(fact_rows(spark, changed))
    monkeypatch.undo()
    assert store.version() == 1
    assert_as_rebuilt(spark, store, rows)
    kept = [r for r in rows if r[5] not in {c[5] for c in changed}]
    assert store.refresh(fact_rows(spark, changed)) == 2  # the failed attempt's files are named by nothing
    assert_as_rebuilt(spark, store, kept + changed)


def test_only_touched_days_and_parts_are_written_and_read(spark):
    store = incremental_marts(spark, parts=16)
    rows = [(f"o{k % 5}", "u1", "t", "add", 1.0, d) for k, d in enumerate(DAYS * 3)]
    store.refresh(fact_rows(spark, rows))
    store.refresh(fact_rows(spark, [("o1", "u1", "t", "add", 4.0, DAYS[3])]))
    days = {r[0]: r[1].split("-")[0] for r in store._directory("days", "period", 2).select("period", "generation").collect()}
    assert {str(d) for d, g in days.items() if g == "2"} == {DAYS[3]} and len(days) == len(DAYS)
    touched = store.state(2).where("n_amount > 0").select("part").distinct().count()
    rewritten = store._directory("state", "part", 2).where(F.col("generation").startswith("2-")).count()
    assert 0 < rewritten < touched
    plan = store.days()._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan  # folders of other generations are pruned before files are read
