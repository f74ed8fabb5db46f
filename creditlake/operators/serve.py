"""Serving queries over the stored marts: filter, sort, page, look up, KPIs.

Filters are Column expressions (never SQL text built from user input). Each
serving sort ends in a tie-break over the remaining columns, so a page is the
same on every run. ``limit`` + ``offset`` plan as a top-k (``TakeOrderedAndProject``)
with no global sort of the mart. An offset without a limit, which Spark would
gather into one task, goes by a rank directory (``ranked.py``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.functions.numeric import exact_mean, exact_sum
from creditlake.operators.ranked import store_ranked
from creditlake.schemas import (
    CUSTOMER_SUCCESS_MAX_LIMIT,
    EXECUTIVE_MAX_LIMIT,
    FINANCE_MAX_LIMIT,
)


def check_page(limit: int | None, offset: int | None, max_limit: int, allow_offset: bool = True) -> None:
    """Limit in 1..max_limit or None; offset >= 0 (0 or None when not allowed)."""
    if limit is not None and (isinstance(limit, bool) or not 1 <= int(limit) <= max_limit):
        raise ValueError(f"limit must be between 1 and {max_limit}, got {limit!r}")
    if offset is not None and int(offset) < 0:
        raise ValueError(f"offset must be >= 0, got {offset!r}")
    if not allow_offset and offset:
        raise ValueError("offset is not supported here")


def equality_filters(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """AND of ``column = value`` for every truthy value."""
    cond: Column | None = None
    for column, value in filters.items():
        if not value:
            continue
        term = F.col(column) == F.lit(value)
        cond = term if cond is None else cond & term
    return df if cond is None else df.where(cond)


def _tie_break(df: DataFrame, used: list[str]) -> list[Column]:
    return [F.asc_nulls_first(c) for c in df.columns if c not in used]


def page(
    df: DataFrame,
    order: list[Column],
    order_names: list[str],
    limit: int | None,
    offset: int | None,
) -> DataFrame:
    by = [*order, *_tie_break(df, order_names)]
    if offset and not limit:
        return store_ranked(df, by).page(offset=int(offset))
    out = df.orderBy(*by)
    if offset:
        out = out.offset(int(offset))
    if limit:
        out = out.limit(int(limit))
    return out


def customer_success_order(mart: DataFrame) -> list[Column]:
    """The total order of ``customer_success_page``, for ``store_ranked``."""
    names = ["total_actions", "organization", "user_name", "user_email"]
    return [F.desc_nulls_first(names[0]), *[F.asc_nulls_first(c) for c in names[1:]], *_tie_break(mart, names)]


def finance_page(
    mart: DataFrame,
    invoice_status: str | None = None,
    limit: int | None = None,
    offset: int | None = 0,
) -> DataFrame:
    """O7 + P7 over ``enhanced_finance_view``: balance descending (NULL first), then org_id."""
    check_page(limit, offset, FINANCE_MAX_LIMIT)
    filtered = equality_filters(mart, {"invoice_status": invoice_status})
    order = [F.desc_nulls_first("net_credit_balance"), F.asc_nulls_first("org_id")]
    return page(filtered, order, ["net_credit_balance", "org_id"], limit, offset)


def finance_lookup(mart: DataFrame, org_id: str) -> DataFrame:
    """P10: the organisation's row, or an empty frame when not found."""
    return mart.where(F.col("org_id") == F.lit(org_id)).limit(1)


def customer_success_page(
    mart: DataFrame,
    engagement_level: str | None = None,
    customer_status: str | None = None,
    organization: str | None = None,
    user: str | None = None,
    limit: int | None = None,
    offset: int | None = 0,
) -> DataFrame:
    """O8 + P8 over ``enhanced_customer_success_view``: total_actions descending."""
    check_page(limit, offset, CUSTOMER_SUCCESS_MAX_LIMIT)
    filtered = equality_filters(
        mart,
        {
            "engagement_level": engagement_level,
            "customer_status": customer_status,
            "organization": organization,
            "user_name": user,
        },
    )
    order = [
        F.desc_nulls_first("total_actions"),
        F.asc_nulls_first("organization"),
        F.asc_nulls_first("user_name"),
        F.asc_nulls_first("user_email"),
    ]
    return page(filtered, order, ["total_actions", "organization", "user_name", "user_email"], limit, offset)


def executive_page(
    mart: DataFrame, industry: str | None = None, limit: int | None = None
) -> DataFrame:
    """O9 + P9 over ``executive_summary_view``: volume descending, no offset."""
    check_page(limit, 0, EXECUTIVE_MAX_LIMIT)
    filtered = equality_filters(mart, {"industry": industry})
    order = [F.desc_nulls_first("total_credit_volume"), F.asc_nulls_first("organization")]
    return page(filtered, order, ["total_credit_volume", "organization"], limit, 0)


def platform_metrics(executive: DataFrame) -> DataFrame:
    """One row of platform KPIs over the executive mart."""
    return executive.agg(
        F.countDistinct("organization").alias("total_organizations"),
        F.sum("total_users").cast("long").alias("total_users"),
        exact_sum("total_credit_volume").alias("platform_credit_volume"),
        exact_mean("avg_credit_per_action").alias("platform_avg_credit_per_action"),
        F.count(F.lit(1)).alias("active_organizations"),
    )


def industry_breakdown(executive: DataFrame) -> DataFrame:
    """Organisations and volume per industry, largest volume first."""
    return (
        executive.groupBy("industry")
        .agg(
            F.count(F.lit(1)).alias("org_count"),
            exact_sum("total_credit_volume").alias("industry_volume"),
        )
        .orderBy(F.desc_nulls_first("industry_volume"), F.asc_nulls_first("industry"))
    )
