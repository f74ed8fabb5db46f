"""Serving: O7-O10 pages, P7-P10 filters and lookup, A17-A18 KPIs."""

from __future__ import annotations

import pytest

from creditlake.operators import serve as S

FIN_DDL = (
    "organization string, industry string, org_id string, net_credit_balance double, "
    "total_credits_added double, total_credits_used double, active_users bigint, "
    "total_transactions bigint, invoice_status string, avg_transaction_value double"
)
EXEC_DDL = (
    "organization string, industry string, total_users bigint, active_days bigint, "
    "total_credit_volume double, total_actions bigint, avg_credit_per_action double, "
    "primary_action_type string, most_active_user string, first_activity date, last_activity date"
)


@pytest.fixture()
def finance(spark):
    rows = [
        (f"Org {i}", "Tech", f"o{i}", bal, 0.0, 0.0, 1, 1, status, 1.0)
        for i, (bal, status) in enumerate(
            [
                (5.0, "In Credit - No Action Required"),
                (5.0, "In Credit - No Action Required"),  # tie across a page border
                (None, "Balanced - No Action Required"),  # NULL sorts first
                (-1.0, "In Debit - Invoice Required"),
                (3.0, "In Credit - No Action Required"),
            ]
        )
    ]
    return spark.createDataFrame(rows, FIN_DDL)


def test_finance_pages_are_stable(finance):
    order = [r.org_id for r in S.finance_page(finance).collect()]
    assert order == ["o2", "o0", "o1", "o4", "o3"]
    pages = [
        [r.org_id for r in S.finance_page(finance, limit=2, offset=k).collect()] for k in (0, 2, 4)
    ]
    assert pages == [["o2", "o0"], ["o1", "o4"], ["o3"]]
    assert S.finance_page(finance, limit=2, offset=10).collect() == []


def test_finance_filter_and_lookup(finance):
    got = [r.org_id for r in S.finance_page(finance, invoice_status="In Credit - No Action Required").collect()]
    assert got == ["o0", "o1", "o4"]
    assert [r.org_id for r in S.finance_page(finance, invoice_status="").collect()] == [
        "o2", "o0", "o1", "o4", "o3",
    ]
    assert S.finance_lookup(finance, "o3").collect()[0].net_credit_balance == -1.0
    assert S.finance_lookup(finance, "nope").collect() == []
    # a quote in a value is data, not SQL
    assert S.finance_page(finance, invoice_status="x' OR '1'='1").collect() == []


@pytest.mark.parametrize("limit,offset", [(0, 0), (101, 0), (-1, 0), (5, -1)])
def test_page_bounds(finance, limit, offset):
    with pytest.raises(ValueError):
        S.finance_page(finance, limit=limit, offset=offset)


def test_executive_page_bounds_and_filter(spark):
    rows = [
        (f"Org {i}", ind, 1, 1, vol, 1, 1.0, "add", "Ann", None, None)
        for i, (ind, vol) in enumerate([("A", 3.0), ("B", 9.0), ("A", 7.0)])
    ]
    mart = spark.createDataFrame(rows, EXEC_DDL)
    assert [r.organization for r in S.executive_page(mart, limit=50).collect()] == ["Org 1", "Org 2", "Org 0"]
    assert [r.organization for r in S.executive_page(mart, industry="A", limit=1).collect()] == ["Org 2"]
    with pytest.raises(ValueError):
        S.executive_page(mart, limit=51)
    metrics = S.platform_metrics(mart).collect()[0]
    assert tuple(metrics) == (3, 3, 19.0, 1.0, 3)
    breakdown = [tuple(r) for r in S.industry_breakdown(mart).collect()]
    assert breakdown == [("A", 2, 10.0), ("B", 1, 9.0)]


def test_customer_success_filters(spark):
    ddl = (
        "organization string, user_name string, user_email string, total_actions bigint, "
        "engagement_level string, customer_status string"
    )
    rows = [
        ("A", "Ann", "a@x", 50, "Power User", "Healthy"),
        ("A", "Bob", "b@x", 50, "Power User", "At Risk - Inactive"),
        ("B", "Ann", "c@x", 3, "Light User", "Healthy"),
    ]
    mart = spark.createDataFrame(rows, ddl)
    page = S.customer_success_page(mart, engagement_level="Power User", customer_status="Healthy")
    assert [(r.organization, r.user_name) for r in page.collect()] == [("A", "Ann")]
    assert [r.user_email for r in S.customer_success_page(mart, user="Ann").collect()] == ["a@x", "c@x"]
    assert [r.user_email for r in S.customer_success_page(mart, limit=1, offset=1).collect()] == ["b@x"]
