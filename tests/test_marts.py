"""Marts A1-A5 with labels L1-L4 and top-1 lookups W2/W3."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from creditlake.operators import marts as M
from conftest import ORGS_DDL, USERS_DDL, by_key, fact_rows


def _orgs(spark, rows=None):
    rows = rows or [("o1", "Org One", "Tech"), ("o2", "Org Two", "Retail")]
    return spark.createDataFrame(rows, ORGS_DDL)


def _users(spark, rows=None):
    rows = rows or [
        ("u1", "Ann", "ann@x", "o1", "admin"),
        ("u2", "Bob", "bob@x", "o1", "user"),
        ("u3", "Cid", "cid@x", "o2", "user"),
    ]
    return spark.createDataFrame(rows, USERS_DDL)


def test_usage_level_thresholds(spark):
    rows = []
    for user, size in [("u1", 1), ("u2", 4), ("u3", 5), ("u4", 9), ("u5", 10)]:
        rows += [("o1", user, "t", "add", 1.0, "2024-01-01")] * size
    rows.append(("o1", "u1", "default", "add", 1.0, "2024-01-01"))  # filtered out
    rows.append(("o1", "u1", None, "add", 1.0, "2024-01-01"))  # NULL type drops too
    rows.append(("o1", "u1", "t", None, 1.0, "2024-01-01"))  # NULL action drops
    got = {r.user_id: (r.action_count, r.usage_level) for r in M.cs_daily_activity(fact_rows(spark, rows)).collect()}
    assert got == {
        "u1": (1, "Low Usage"),
        "u2": (4, "Low Usage"),
        "u3": (5, "Medium Usage"),
        "u4": (9, "Medium Usage"),
        "u5": (10, "High Usage"),
    }


def test_daily_activity_sums_all_actions_plainly(spark):
    rows = [
        ("o1", "u1", "t", "add", 2.5, "2024-01-01 10:00:00"),
        ("o1", "u1", "t", "add", 0.1, "2024-01-01 23:59:59"),
        ("o1", "u1", "t", "add", 0.2, "2024-01-02 00:00:00"),
    ]
    got = sorted((r.activity_date, r.total_credits_used) for r in M.cs_daily_activity(fact_rows(spark, rows)).collect())
    assert got == [(dt.date(2024, 1, 1), 2.6), (dt.date(2024, 1, 2), 0.2)]


def test_finance_balance_counts_every_row(spark):
    rows = [
        ("o1", "u1", "default", "add", 10.0, "2024-01-01"),
        ("o1", "u1", "t", "deduct", 3.0, "2024-01-01"),
        ("o1", "u1", "t", "error", 100.0, "2024-01-01"),
        ("o1", "u1", "t", None, 100.0, "2024-01-01"),
        ("o9", "u9", "t", "add", 1.0, "2024-01-01"),  # org absent from the dimension
    ]
    ua = fact_rows(spark, rows)
    balance = {r.org_id: r.total_credits for r in M.finance_org_balance(ua).collect()}
    assert balance == {"o1": 7.0, "o9": 1.0}
    mart = by_key(M.finance_mart(ua, _orgs(spark)).collect(), "org_id")
    assert set(mart) == {"o1"}  # inner join: o9 vanishes here, unlike the balance
    o1 = mart["o1"]
    assert (o1.net_credit_balance, o1.total_credits_added, o1.total_credits_used) == (7.0, 10.0, 3.0)
    assert (o1.active_users, o1.total_transactions) == (1, 4)
    assert o1.avg_transaction_value == 53.25
    assert o1.invoice_status == "In Credit - No Action Required"


def test_invoice_status_signs(spark):
    rows = [
        ("o1", "u1", "t", "add", 5.0, "2024-01-01"),
        ("o2", "u3", "t", "deduct", 5.0, "2024-01-01"),
        ("o3", "u3", "t", "add", 5.0, "2024-01-01"),
        ("o3", "u3", "t", "deduct", 5.0, "2024-01-01"),
    ]
    orgs = _orgs(spark, [("o1", "A", "x"), ("o2", "B", "x"), ("o3", "C", "x")])
    got = {r.org_id: r.invoice_status for r in M.finance_mart(fact_rows(spark, rows), orgs).collect()}
    assert got == {
        "o1": "In Credit - No Action Required",
        "o2": "In Debit - Invoice Required",
        "o3": "Balanced - No Action Required",
    }


def test_engagement_levels(spark):
    rows = []
    users = []
    for i, size in enumerate([1, 4, 5, 19, 20, 49, 50]):
        users.append((f"u{i}", f"User {i}", f"u{i}@x", "o1", "r"))
        rows += [("o1", f"u{i}", "t", "add", 1.0, "2024-01-01")] * size
    mart = M.cs_user_mart(fact_rows(spark, rows), _orgs(spark), _users(spark, users), "2024-01-10")
    got = {r.user_name: r.engagement_level for r in mart.collect()}
    assert got == {
        "User 0": "Light User",
        "User 1": "Light User",
        "User 2": "Regular User",
        "User 3": "Regular User",
        "User 4": "Active User",
        "User 5": "Active User",
        "User 6": "Power User",
    }


def test_customer_status_rules(spark):
    as_of = "2024-03-31"  # as_of - 30 days = 2024-03-01
    users = [(f"u{i}", f"User {i}", f"u{i}@x", "o1", "r") for i in range(6)]
    rows = [
        ("o1", "u0", "t", "deduct", 1.0, "2024-03-01"),  # exactly as_of-30: not at risk
        ("o1", "u1", "t", "deduct", 1.0, "2024-02-29"),  # as_of-31: at risk
        ("o1", "u2", "t", "add", 5.0, "2024-03-20"),  # consumed 0
        ("o1", "u3", "t", "add", 1.0, "2024-03-20"),
        ("o1", "u3", "t", "deduct", 1.01, "2024-03-20"),  # net -0.01
        ("o1", "u4", "t", "add", 1.0, "2024-03-20"),
        ("o1", "u4", "t", "deduct", 1.0, "2024-03-20"),  # net 0, consumed > 0
    ]
    mart = M.cs_user_mart(fact_rows(spark, rows), _orgs(spark), _users(spark, users), as_of)
    got = {r.user_name: r.customer_status for r in mart.collect()}
    assert got == {
        "User 0": "Low Balance - Upsell Opportunity",
        "User 1": "At Risk - Inactive",
        "User 2": "Not Using Credits",
        "User 3": "Low Balance - Upsell Opportunity",
        "User 4": "Healthy",
    }


def test_cs_user_mart_measures_and_rounding(spark):
    rows = [
        ("o1", "u1", "t", "add", 3.0, "2024-01-01"),
        ("o1", "u1", "t", "deduct", 1.0, "2024-01-01"),
        ("o1", "u1", "t", "deduct", 1.01, "2024-01-02"),
        ("o1", "u1", "t", "error", 9.0, "2024-01-03"),
    ]
    r = M.cs_user_mart(fact_rows(spark, rows), _orgs(spark), _users(spark), "2024-01-05").collect()[0]
    assert (r.organization, r.industry, r.user_name, r.user_role, r.user_email) == (
        "Org One", "Tech", "Ann", "admin", "ann@x",
    )
    assert (r.first_activity_date, r.last_activity_date, r.active_days) == (
        dt.date(2024, 1, 1), dt.date(2024, 1, 3), 3,
    )
    assert (r.net_credit_balance, r.total_credits_purchased, r.total_credits_consumed) == (0.99, 3.0, 2.01)
    assert (r.total_actions, r.purchase_actions, r.usage_actions) == (4, 1, 2)
    assert r.avg_daily_usage == 0.67  # 2.01 / 3 = 0.67


def test_round_half_away_from_zero(spark):
    rows = [
        ("o1", "u1", "t", "deduct", 1.0, "2024-01-01"),
        ("o1", "u1", "t", "deduct", 1.01, "2024-01-02"),  # 2.01 / 2 = 1.005 -> 1.01
    ]
    r = M.cs_user_mart(fact_rows(spark, rows), _orgs(spark), _users(spark), "2024-01-05").collect()[0]
    assert r.avg_daily_usage == 1.01
    assert M.cs_user_mart(fact_rows(spark, rows), _orgs(spark), _users(spark), "2024-01-05").schema[
        "avg_daily_usage"
    ].nullable


def test_cs_user_mart_merges_same_named_orgs_and_uses_action_org(spark):
    orgs = [("o1", "Same", "Tech"), ("o2", "Same", "Tech")]
    users = [("u1", "Ann", "ann@x", "o1", "admin")]
    rows = [
        ("o1", "u1", "t", "add", 1.0, "2024-01-01"),
        ("o2", "u1", "t", "add", 1.0, "2024-01-01"),  # outside the home org, same name
    ]
    out = M.cs_user_mart(fact_rows(spark, rows), _orgs(spark, orgs), _users(spark, users), "2024-01-05").collect()
    assert len(out) == 1 and out[0].total_actions == 2 and out[0].active_days == 1


def test_executive_summary(spark):
    users = [
        ("u1", "Ann", "a@x", "o1", "r"),
        ("u2", "Ann", "a2@x", "o1", "r"),  # a second user with the same name
        ("u3", "Bob", "b@x", "o1", "r"),
        ("u4", "Dee", "d@x", "o2", "r"),
    ]
    rows = [
        ("o1", "u1", "t", "add", 1.0, "1990-01-01"),
        ("o1", "u1", "t", "add", 2.0, "2024-01-02"),
        ("o1", "u2", "t", "deduct", 3.0, "2024-01-05"),
        ("o1", "u3", "t", "deduct", 4.0, "2024-01-03"),
        ("o1", "u3", "default", "deduct", 5.0, "2024-01-09"),  # counts only in the lookups
        ("o1", "u3", "default", "deduct", 5.0, "2024-01-09"),
        ("o1", "u9", "t", "add", 7.0, "2024-01-04"),  # user not in the dimension
        ("o2", "u4", "default", "add", 1.0, "2024-01-01"),  # o2 has only 'default' rows
    ]
    out = M.executive_summary(fact_rows(spark, rows), _orgs(spark), _users(spark, users)).collect()
    assert [r.organization for r in out] == ["Org One"]
    r = out[0]
    assert (r.total_users, r.active_days, r.total_credit_volume, r.total_actions) == (3, 4, 10.0, 4)
    assert r.avg_credit_per_action == 2.5
    assert r.primary_action_type == "deduct"  # 4 deducts vs 3 adds over all rows
    # Ann = u1 (2) + u2 (1); Bob = u3 (3, 'default' rows included); tie -> name order
    assert r.most_active_user == "Ann"
    assert (r.first_activity, r.last_activity) == (dt.date(2024, 1, 2), dt.date(2024, 1, 5))


def test_executive_sentinel_only_and_null_action(spark):
    rows = [
        ("o1", "u1", "t", None, 1.0, "1990-01-01"),
        ("o1", "u1", "t", None, 1.0, "1990-01-01"),
        ("o1", "u1", "t", "add", 1.0, "1990-01-01"),
    ]
    r = M.executive_summary(fact_rows(spark, rows), _orgs(spark), _users(spark)).collect()[0]
    assert r.first_activity is None and r.last_activity == dt.date(1990, 1, 1)
    assert r.primary_action_type is None


def test_top1_ties_break_by_value(spark):
    rows = [
        ("o1", "u1", "t", "deduct", 1.0, "2024-01-01"),
        ("o1", "u2", "t", "add", 1.0, "2024-01-01"),
        ("o1", "u2", "t", None, 1.0, "2024-01-01"),
    ]
    ua = fact_rows(spark, rows)
    action = M.primary_action_per_org(ua).collect()[0]
    assert (action.primary_action_type, action.primary_action_count) == (None, 1)
    user = M.most_active_user_per_org(ua, _users(spark)).collect()[0]
    assert (user.most_active_user, user.most_active_user_actions) == ("Bob", 2)


def test_marts_equal_from_fact_and_from_rollup(spark):
    rows = [
        ("o1", "u1", "t", "add", 1.25, "2024-01-01 01:00:00"),
        ("o1", "u1", "t", "add", 2.5, "2024-01-01 02:00:00"),
        ("o1", "u2", "default", "deduct", 4.0, "2024-01-02"),
        ("o2", "u3", "t", "deduct", 0.3, "2024-01-02"),
        ("o2", "u3", "t", None, None, "2024-01-03"),
    ]
    ua = fact_rows(spark, rows)
    rollup = M.daily_rollup(ua)
    orgs, users = _orgs(spark), _users(spark)
    pairs = [
        (M.cs_daily_activity(ua), M.cs_daily_activity(rollup)),
        (M.cs_daily_activity(ua), M.cs_daily_activity(rollup, rolled_up=True)),
        (M.finance_org_balance(ua), M.finance_org_balance(rollup)),
        (M.finance_mart(ua, orgs), M.finance_mart(rollup, orgs)),
        (M.cs_user_mart(ua, orgs, users, "2024-01-05"), M.cs_user_mart(rollup, orgs, users, "2024-01-05")),
        (M.executive_summary(ua, orgs, users), M.executive_summary(rollup, orgs, users, materialize=False)),
    ]
    for direct, rolled in pairs:
        assert sorted(direct.collect()) == sorted(rolled.collect())


def test_read_order(spark):
    rows = [
        ("o1", "u1", "t", "add", 1.0, "2024-01-01"),
        ("o2", "u3", "t", "add", 5.0, "2024-01-02"),
    ]
    mart = M.finance_mart(fact_rows(spark, rows), _orgs(spark))
    ordered = M.in_read_order(mart, "enhanced_finance_view").collect()
    assert [r.org_id for r in ordered] == ["o2", "o1"]
    assert M.in_read_order(mart.select("*"), "enhanced_finance_view").select(F.col("org_id")).count() == 2


def test_read_orders_of_every_mart(spark):
    rows = [
        ("o1", "u1", "t", "add", 1.0, "2024-01-01"),
        ("o1", "u2", "t", "deduct", 9.0, "2024-01-03"),
        ("o2", "u3", "t", "add", 5.0, "2024-01-03"),
        ("o2", "u3", "t", "add", 6.0, "2024-01-02"),
    ]
    ua, orgs, users = fact_rows(spark, rows), _orgs(spark), _users(spark)
    daily = M.in_read_order(M.cs_daily_activity(ua), "customer_success_daily_activity").collect()
    assert [(str(r.activity_date), r.org_id, r.user_id) for r in daily] == [
        ("2024-01-03", "o1", "u2"), ("2024-01-03", "o2", "u3"),
        ("2024-01-02", "o2", "u3"), ("2024-01-01", "o1", "u1"),
    ]
    balance = M.in_read_order(M.finance_org_balance(ua), "finance_org_credit_balance").collect()
    assert [r.org_id for r in balance] == ["o1", "o2"]
    cs = M.in_read_order(M.cs_user_mart(ua, orgs, users, "2024-01-05"), "enhanced_customer_success_view")
    assert [(r.total_actions, r.organization, r.user_name) for r in cs.collect()] == [
        (2, "Org Two", "Cid"), (1, "Org One", "Ann"), (1, "Org One", "Bob"),
    ]
    ex = M.in_read_order(M.executive_summary(ua, orgs, users), "executive_summary_view").collect()
    assert [(r.organization, r.total_credit_volume) for r in ex] == [("Org Two", 11.0), ("Org One", 10.0)]


def test_sample_rows_is_bounded(spark):
    from creditlake.operators.quality import sample_rows

    df = spark.range(100)
    assert len(sample_rows(df, 5).collect()) == 5
    assert len(sample_rows(spark.range(3), 10).collect()) == 3


def test_executive_null_timestamp_counts_as_action_not_day(spark):
    ddl = "org_id string, user_id string, credit_type string, action string, credits double, timestamp timestamp"
    rows = [
        ("o1", "u1", "t", "add", 1.0, None),
        ("o1", "u1", "t", "add", 2.0, dt.datetime(2024, 1, 2)),
    ]
    ua = spark.createDataFrame(rows, ddl)
    for stored in (True, False):
        r = M.executive_summary(ua, _orgs(spark), _users(spark), materialize=stored).collect()[0]
        assert (r.total_actions, r.active_days, r.total_credit_volume) == (2, 1, 3.0)
        assert (r.first_activity, r.last_activity) == (dt.date(2024, 1, 2), dt.date(2024, 1, 2))


def test_credits_of_any_size_are_neither_rounded_nor_dropped(spark):
    """More than four decimals, totals beyond a long of units, 1e300 and NaN."""
    rows = [("o", "u", "t", "add", x, "2024-01-01") for x in (0.00004, 0.00004, 0.00004)]
    rows += [("big", "u", "t", "add", 1e15, "2024-01-01"), ("big", "u", "t", "deduct", 0.25, "2024-01-01")]
    rows += [("huge", "u", "t", "add", 1e300, "2024-01-01"), ("nan", "u", "t", "add", float("nan"), "2024-01-01")]
    found = {r["org_id"]: r["total_credits"] for r in M.finance_org_balance(fact_rows(spark, rows)).collect()}
    assert found["o"] == pytest.approx(0.00012, rel=1e-12)
    assert found["big"] == 1e15 - 0.25
    assert found["huge"] == 1e300
    assert math.isnan(found["nan"])
