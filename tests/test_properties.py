"""Property tests: conservation laws of the marts and invariance to partitioning."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creditlake.operators import marts as M
from creditlake.operators.clean import clean, first_org_per_user, prepare, single_org_filter
from conftest import FACT_DDL, ORGS_DDL, USERS_DDL, raw_rows

ORGS = [("o1", "One", "Tech"), ("o2", "Two", "Tech"), ("o3", "Three", "Retail")]
USERS = [(f"u{i}", f"Name {i % 3}", f"u{i}@x", "o1", "r") for i in range(5)]

_fact_row = st.tuples(
    st.sampled_from(["o1", "o2", "o3", "o9"]),
    st.sampled_from(["u0", "u1", "u2", "u3", "u4", "u9"]),
    st.sampled_from(["t1", "t2", "default", None]),
    st.sampled_from(["add", "deduct", "error", None]),
    st.one_of(st.none(), st.decimals(min_value=-1000, max_value=1000, places=2).map(float)),
    st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(1990, 1, 20)),
)
_settings = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _signed(rows):
    total = Decimal(0)
    for _, _, _, action, credits, _ in rows:
        if credits is None:
            continue
        if action == "add":
            total += Decimal(str(credits))
        elif action == "deduct":
            total -= Decimal(str(credits))
    return total


@_settings
@given(st.lists(_fact_row, min_size=1, max_size=40))
def test_balances_conserve_signed_credits(spark, rows):
    ua = spark.createDataFrame(rows, FACT_DDL)
    # an org whose only signed rows have NULL credits has a NULL balance (SQL SUM)
    balances = [r.total_credits or 0.0 for r in M.finance_org_balance(ua).collect()]
    assert abs(Decimal(str(sum(balances))) - _signed(rows)) < Decimal("0.000001")


_clean_fact_row = _fact_row.filter(lambda r: r[4] is not None)  # cleaned credits are never NULL


@_settings
@given(st.lists(_clean_fact_row, min_size=1, max_size=40))
def test_purchased_minus_consumed_is_net(spark, rows):
    ua = spark.createDataFrame(rows, FACT_DDL)
    orgs = spark.createDataFrame(ORGS, ORGS_DDL)
    users = spark.createDataFrame(USERS, USERS_DDL)
    pairs = [(r.total_credits_purchased, r.total_credits_consumed, r.net_credit_balance)
             for r in M.cs_user_mart(ua, orgs, users, "1990-02-01").collect()]
    pairs += [(r.total_credits_added, r.total_credits_used, r.net_credit_balance)
              for r in M.finance_mart(ua, orgs).collect()]
    for plus, minus, net in pairs:
        diff = Decimal(str(plus)) - Decimal(str(minus))
        assert abs(diff - Decimal(str(net))) < Decimal("0.000001")


@_settings
@given(st.lists(_fact_row, min_size=1, max_size=40), st.integers(min_value=1, max_value=7))
def test_marts_do_not_depend_on_partitioning(spark, rows, parts):
    orgs = spark.createDataFrame(ORGS, ORGS_DDL)
    users = spark.createDataFrame(USERS, USERS_DDL)
    one = spark.createDataFrame(rows, FACT_DDL).coalesce(1)
    many = spark.createDataFrame(list(reversed(rows)), FACT_DDL).repartition(parts)
    for build in (
        lambda ua: M.finance_mart(ua, orgs),
        lambda ua: M.cs_daily_activity(ua),
        lambda ua: M.executive_summary(ua, orgs, users, materialize=False),
    ):
        assert sorted(build(one).collect()) == sorted(build(many).collect())


def test_hot_user_with_a_third_of_rows(spark):
    """One user holds a third of all rows: cleaning and marts stay exact at any partitioning."""
    rows = []
    for i in range(600):
        user = "hot" if i % 3 == 0 else f"u{i % 50}"
        org = "o2" if (user == "hot" and i == 0) else "o1"
        rows.append((org, user, "t", "add" if i % 2 else "deduct", "1.5", f"2024-01-{1 + i % 28:02d} 00:00:00"))
    raw = raw_rows(spark, rows).repartition(7)
    firsts = {r.user_id: r.first_org for r in first_org_per_user(prepare(raw)).collect()}
    assert firsts["hot"] == "o2"  # its earliest row (2024-01-01, first in file) is in o2
    cleaned = clean(raw)
    hot_rows = [r for r in cleaned.collect() if r.user_id == "hot"]
    # hot user's rows in o2 are kept, o1 rows dropped; every row of the others survives
    assert len(hot_rows) == 1 and hot_rows[0].org_id == "o2"
    assert cleaned.count() == 1 + sum(1 for r in rows if r[1] != "hot")
    ua = cleaned.repartition(3)
    balance = {r.org_id: r.total_credits for r in M.finance_org_balance(ua).collect()}
    assert set(balance) == {"o1", "o2"}


def test_results_identical_without_broadcasts(spark):
    """One algorithm: with broadcasting off every join shuffles, and the results are the same."""
    rows = [
        ("o1", "u0", "t1", "add", 2.5, dt.datetime(2024, 1, 1)),
        ("o1", "u1", "t2", "deduct", 1.25, dt.datetime(2024, 1, 2)),
        ("o2", "u2", "default", "add", 4.0, dt.datetime(2024, 1, 2)),
        ("o3", "u3", "t1", None, 3.0, dt.datetime(2024, 1, 3)),
        ("o9", "u9", "t1", "add", 1.0, dt.datetime(2024, 1, 3)),
    ]
    ua = spark.createDataFrame(rows, FACT_DDL)
    orgs = spark.createDataFrame(ORGS, ORGS_DDL)
    for users in (USERS, [*USERS, USERS[0]]):  # also with a repeated user_id
        usrs = spark.createDataFrame(users, USERS_DDL)
        builds = (
            lambda: M.finance_mart(ua, orgs),
            lambda usrs=usrs: M.cs_user_mart(ua, orgs, usrs, "2024-01-05"),
            lambda usrs=usrs: M.executive_summary(ua, orgs, usrs),
            lambda usrs=usrs: M.most_active_user_per_org(ua, usrs),
        )
        expected = [sorted(build().collect()) for build in builds]
        with broadcasts_off(spark):
            for build, want in zip(builds, expected):
                shuffled = build()
                plan = shuffled._jdf.queryExecution().sparkPlan().toString()
                assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
                assert sorted(shuffled.collect()) == want


def test_a_hot_user_spans_many_tasks(spark):
    """A user with a third of all rows is dealt out by salts when the join back shuffles."""
    raw = raw_rows(spark, [("o1" if i % 3 else "o2", "hot" if i % 3 == 0 else f"u{i % 50}", "t", "add", "1", None) for i in range(3000)])
    typed = prepare(raw)
    want = sorted(single_org_filter(typed).collect(), key=lambda r: r.seq)
    with broadcasts_off(spark):
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            kept = single_org_filter(typed, hot_rows=50, strategy="shuffle_hash")
            assert "ShuffledHashJoin" in kept._jdf.queryExecution().executedPlan().toString()
            spread = kept.where("user_id = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
            assert len(spread) == int(spark.conf.get("spark.sql.shuffle.partitions"))
            assert sorted(kept.collect(), key=lambda r: r.seq) == want
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


@contextmanager
def broadcasts_off(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        yield
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_raw_row = st.tuples(
    st.sampled_from(["org_1", " ORG_1 ", "org_2", None]),
    st.sampled_from(["u1", "u2", "U1 ", None]),
    st.sampled_from(["t", " Default", None]),
    st.sampled_from(["add", "DEDUCT ", None]),
    st.sampled_from(["1", "2.5", None, "x"]),
    st.sampled_from(["2024-01-01 00:00:00", "2024-01-01 00:00:00", "02-01-2024", "1700000000", "bad", None]),
)


@_settings
@given(st.lists(_raw_row, min_size=1, max_size=30), st.integers(min_value=1, max_value=6))
def test_cleaning_does_not_depend_on_order_or_partitioning(spark, rows, parts):
    raw = raw_rows(spark, rows)  # seq = position, as a file scan would assign it
    shuffled = raw.orderBy("credit_type", "user_id").repartition(parts)
    def by_seq(df):
        return sorted(df.collect(), key=lambda r: r.seq)

    assert by_seq(clean(raw, keep_seq=True)) == by_seq(clean(shuffled, keep_seq=True))
