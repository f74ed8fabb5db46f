"""The five marts, built from one ledger shape.

Every mart reads *ledger rows*: (activity_date, org_id, user_id, action,
credit_type, amount, n, n_amount) where ``amount`` is an exact decimal sum of
credits, ``n`` a row count and ``n_amount`` the count of non-null credits. The
fact table maps to ledger rows one-to-one (``ledger_rows``), and
``daily_rollup`` aggregates them to one row per (day, org, user, action,
credit_type). Because every measure is a sum, count, min/max or distinct count,
a mart computed from the rollup equals the mart computed from the fact; a full
refresh therefore scans the fact once, stores the rollup, and builds all marts
from it.

Joins with the dimensions happen *after* a first aggregation, so a shuffle for
them carries pre-aggregated rows, not raw actions. There is one algorithm for
every size; whether a dimension is broadcast is Spark's choice by its size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.functions.labels import (
    customer_status,
    engagement_level,
    invoice_status,
    usage_level,
)
from creditlake.functions.numeric import (
    amount_to_double,
    ratio,
    round_half_away,
    signed,
    sum_amount,
    to_amount,
)
from creditlake.plans.materialize import materialize as materialize_stage
from creditlake.schemas import ACTION_ADD, ACTION_DEDUCT, DEFAULT_CREDIT_TYPE, SENTINEL_DATE

LEDGER_KEYS = ("activity_date", "org_id", "user_id", "action", "credit_type")
LEDGER_COLUMNS = LEDGER_KEYS + ("amount", "n", "n_amount")


# ---------------------------------------------------------------------------
# Ledger rows
# ---------------------------------------------------------------------------


def ledger_rows(ua: DataFrame) -> DataFrame:
    """Fact rows → ledger rows (no aggregation, no shuffle)."""
    return ua.select(
        F.to_date("timestamp").alias("activity_date"),
        "org_id",
        "user_id",
        "action",
        "credit_type",
        to_amount("credits").alias("amount"),
        F.lit(1).cast("long").alias("n"),
        F.col("credits").isNotNull().cast("long").alias("n_amount"),
    )


def as_ledger(df: DataFrame) -> DataFrame:
    """Accept either the fact table or ledger rows / the daily rollup."""
    if _is_measured(df):
        return df.select(*LEDGER_COLUMNS)
    return ledger_rows(df)


def _is_measured(df: DataFrame) -> bool:
    return {"amount", "n", "n_amount"} <= set(df.columns)


def _measured(df: DataFrame) -> DataFrame:
    """Rows carrying amount / n / n_amount (any pre-aggregate passes through)."""
    return df if _is_measured(df) else ledger_rows(df)


def daily_rollup(df: DataFrame) -> DataFrame:
    """One row per (day, org, user, action, credit_type); partial aggregation map-side."""
    return (
        as_ledger(df)
        .groupBy(*LEDGER_KEYS)
        .agg(
            sum_amount("amount").alias("amount"),
            F.sum("n").alias("n"),
            F.sum("n_amount").alias("n_amount"),
        )
    )


def _is_add() -> Column:
    return F.col("action") == ACTION_ADD


def _is_deduct() -> Column:
    return F.col("action") == ACTION_DEDUCT


def signed_amount() -> Column:
    """Add → +credits, deduct → -credits, anything else → 0."""
    return signed("amount", _is_add(), _is_deduct())


def added_amount() -> Column:
    return signed("amount", _is_add())


def deducted_amount() -> Column:
    return signed("amount", _is_deduct())


def analytics_filter() -> Column:
    """Both ids and the action present, credit_type not 'default' (NULL type drops)."""
    return (
        F.col("user_id").isNotNull()
        & F.col("org_id").isNotNull()
        & F.col("action").isNotNull()
        & (F.col("credit_type") != DEFAULT_CREDIT_TYPE)
    )


def non_default_filter() -> Column:
    """P5: credit_type not 'default'; NULL actions stay."""
    return F.col("credit_type") != DEFAULT_CREDIT_TYPE


# ---------------------------------------------------------------------------
# A1: customer success daily activity
# ---------------------------------------------------------------------------


def cs_daily_activity(ua: DataFrame, rolled_up: bool = False) -> DataFrame:
    """A1. ``rolled_up=True`` means ``ua`` is the daily rollup, already one row per
    mart key, so the mart is a filter and a projection (no shuffle)."""
    led = as_ledger(ua).where(analytics_filter())
    if rolled_up:
        grouped = led.select(
            *LEDGER_KEYS,
            amount_to_double("amount").alias("total_credits_used"),
            F.col("n").alias("action_count"),
        )
    else:
        grouped = led.groupBy(*LEDGER_KEYS).agg(
            amount_to_double(sum_amount("amount")).alias("total_credits_used"),
            F.sum("n").alias("action_count"),
        )
    return grouped.withColumn("usage_level", usage_level("action_count"))


# ---------------------------------------------------------------------------
# A2: finance organisation balance
# ---------------------------------------------------------------------------


def finance_org_balance(ua: DataFrame) -> DataFrame:
    """All rows count (no filter): unknown actions add 0, 'default' rows count."""
    return (
        as_ledger(ua)
        .groupBy("org_id")
        .agg(amount_to_double(sum_amount(signed_amount())).alias("total_credits"))
    )


# ---------------------------------------------------------------------------
# A3: per-user customer success mart
# ---------------------------------------------------------------------------


def cs_user_mart(ua: DataFrame, organizations: DataFrame, users: DataFrame, as_of=None) -> DataFrame:
    """Inner join on the action's org and user; grouped by names (+ user_id).

    The ledger is aggregated per (org, user, day) before the joins. Two
    organisations with one name and industry merge afterwards, as in the
    original grouping. ``as_of`` replaces CURRENT_DATE (None = today).
    """
    led = as_ledger(ua).where(analytics_filter())
    orgs = organizations.select("org_id", "org_name", "industry")
    usrs = users.select("user_id", "user_name", "role", "email")
    keys = ["org_name", "industry", "user_name", "role", "email", "user_id"]
    per_org_day = led.groupBy("org_id", "user_id", "activity_date").agg(
        sum_amount(signed_amount()).alias("net"),
        sum_amount(added_amount()).alias("purchased"),
        sum_amount(deducted_amount()).alias("consumed"),
        F.sum("n").alias("n"),
        F.sum(F.when(_is_add(), F.col("n")).otherwise(0)).alias("n_add"),
        F.sum(F.when(_is_deduct(), F.col("n")).otherwise(0)).alias("n_deduct"),
    )
    per_day = (
        per_org_day.join(orgs, "org_id")
        .join(usrs, "user_id")
        .groupBy(*keys, "activity_date")
        .agg(
            *[sum_amount(c).alias(c) for c in ("net", "purchased", "consumed")],
            *[F.sum(c).alias(c) for c in ("n", "n_add", "n_deduct")],
        )
    )
    # one row per (user key, day): distinct days are a count of non-NULL days
    grouped = per_day.groupBy(*keys).agg(
        F.min("activity_date").alias("first_activity_date"),
        F.max("activity_date").alias("last_activity_date"),
        F.count("activity_date").alias("active_days"),
        amount_to_double(sum_amount("net")).alias("net_credit_balance"),
        amount_to_double(sum_amount("purchased")).alias("total_credits_purchased"),
        amount_to_double(sum_amount("consumed")).alias("total_credits_consumed"),
        F.sum("n").alias("total_actions"),
        F.sum("n_add").alias("purchase_actions"),
        F.sum("n_deduct").alias("usage_actions"),
    )
    return grouped.select(
        F.col("org_name").alias("organization"),
        "industry",
        "user_name",
        F.col("role").alias("user_role"),
        F.col("email").alias("user_email"),
        "first_activity_date",
        "last_activity_date",
        "active_days",
        "net_credit_balance",
        "total_credits_purchased",
        "total_credits_consumed",
        "total_actions",
        "purchase_actions",
        "usage_actions",
        engagement_level("total_actions").alias("engagement_level"),
        customer_status(
            "last_activity_date", "total_credits_consumed", "net_credit_balance", as_of
        ).alias("customer_status"),
        round_half_away(ratio(F.col("total_credits_consumed"), F.col("active_days"))).alias(
            "avg_daily_usage"
        ),
    )


# ---------------------------------------------------------------------------
# A4: finance mart
# ---------------------------------------------------------------------------


def finance_mart(ua: DataFrame, organizations: DataFrame) -> DataFrame:
    """Per organisation; actions of orgs missing from the dimension vanish (inner join).

    Aggregated per org_id first, then joined: org_id is the dimension's key, so
    this equals join-then-group.
    """
    per_org = as_ledger(ua).groupBy("org_id").agg(
        sum_amount(signed_amount()).alias("net"),
        sum_amount(added_amount()).alias("added"),
        sum_amount(deducted_amount()).alias("used"),
        F.countDistinct("user_id").alias("active_users"),
        F.sum("n").alias("total_transactions"),
        sum_amount("amount").alias("amount"),
        F.sum("n_amount").alias("n_amount"),
    )
    joined = per_org.join(organizations.select("org_id", "org_name", "industry"), "org_id")
    net = amount_to_double("net")
    return joined.select(
        F.col("org_name").alias("organization"),
        "industry",
        "org_id",
        net.alias("net_credit_balance"),
        amount_to_double("added").alias("total_credits_added"),
        amount_to_double("used").alias("total_credits_used"),
        "active_users",
        "total_transactions",
        invoice_status(net).alias("invoice_status"),
        round_half_away(ratio(amount_to_double("amount"), F.col("n_amount"))).alias(
            "avg_transaction_value"
        ),
    )


# ---------------------------------------------------------------------------
# Top-1 per organisation
# ---------------------------------------------------------------------------


def primary_action_per_org(ua: DataFrame) -> DataFrame:
    """Most frequent action over *all* rows of the org (NULL is a value).

    Ties: action ascending with NULL first. Two aggregations with map-side
    combine; no group is ever collected into one task.
    """
    counts = _measured(ua).groupBy("org_id", "action").agg(F.sum("n").alias("cnt"))
    order_key = F.struct(
        (-F.col("cnt")).alias("neg_cnt"),
        F.col("action").isNotNull().alias("not_null"),
        F.col("action").alias("action"),
    )
    best = F.min_by(F.struct("action", "cnt"), order_key)
    return counts.groupBy("org_id").agg(best.alias("best")).select(
        "org_id",
        F.col("best.action").alias("primary_action_type"),
        F.col("best.cnt").alias("primary_action_count"),
    )


def most_active_user_per_org(ua: DataFrame, users: DataFrame) -> DataFrame:
    """User name with most actions in the org (all rows; one name = one group).

    Counts are taken per (org, user_id) before the join, so it carries one row
    per active user instead of one per action. Ties: name ascending.
    """
    per_user = _measured(ua).groupBy("org_id", "user_id").agg(F.sum("n").alias("n"))
    return _top_user(per_user.join(users.select("user_id", "user_name"), "user_id"))


def _top_user(named: DataFrame) -> DataFrame:
    """Top-1 ``user_name`` per org over rows carrying (org_id, user_name, n)."""
    per_name = named.groupBy("org_id", "user_name").agg(F.sum("n").alias("cnt"))
    order_key = F.struct(
        (-F.col("cnt")).alias("neg_cnt"),
        F.col("user_name").isNotNull().alias("not_null"),
        F.col("user_name").alias("user_name"),
    )
    best = F.min_by(F.struct("user_name", "cnt"), order_key)
    return per_name.groupBy("org_id").agg(best.alias("best")).select(
        "org_id",
        F.col("best.user_name").alias("most_active_user"),
        F.col("best.cnt").alias("most_active_user_actions"),
    )


# ---------------------------------------------------------------------------
# A5: executive summary
# ---------------------------------------------------------------------------


def executive_summary(
    ua: DataFrame, organizations: DataFrame, users: DataFrame, materialize: bool = True
) -> DataFrame:
    """Per organisation, over non-'default' rows whose org and user are known.

    ``first_activity`` skips the 1990-01-01 sentinel; ``last_activity`` does not.
    The top action is over all rows of the org, the top user name over rows of
    known users.

    The fact is aggregated once per (org, user, action, kept by the filter,
    day), and that is stored: it feeds four small aggregates, one a grain
    (distinct users and days are plain row counts of theirs), and column pruning
    would otherwise give each a scan of the fact of its own. ``materialize=False``
    is for an ``ua`` that is stored already, e.g. the daily rollup.
    """
    base = (
        as_ledger(ua)
        .groupBy(
            "org_id",
            "user_id",
            "action",
            F.coalesce(non_default_filter(), F.lit(False)).alias("kept"),
            "activity_date",
        )
        .agg(
            sum_amount("amount").alias("amount"),
            F.sum("n").alias("n"),
            F.sum("n_amount").alias("n_amount"),
        )
    )
    if materialize:
        base = materialize_stage(base, "executive-base")
    named = base.join(users.select("user_id", "user_name"), "user_id")
    counted = named.where("kept")
    day = F.col("activity_date")
    per_user = counted.groupBy("org_id", "user_id").agg(
        sum_amount("amount").alias("amount"), F.sum("n").alias("n"), F.sum("n_amount").alias("n_amount")
    )
    volume = per_user.groupBy("org_id").agg(
        F.count("user_id").alias("total_users"),
        sum_amount("amount").alias("amount"),
        F.sum("n").alias("total_actions"),
        F.sum("n_amount").alias("n_amount"),
    )
    days = counted.select("org_id", "activity_date").distinct()
    span = days.groupBy("org_id").agg(
        F.count("activity_date").alias("active_days"),  # COUNT(DISTINCT) skips NULL
        F.min(F.when(day > F.lit(SENTINEL_DATE).cast("date"), day)).alias("first_activity"),
        F.max(day).alias("last_activity"),
    )
    # One row an organisation in each of the four: put side by side by a union, not by joins.
    parts = [volume, span, primary_action_per_org(base), _top_user(named)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    columns = [c for c in stacked.columns if c != "org_id"]
    per_org = stacked.groupBy("org_id").agg(*[F.max(c).alias(c) for c in columns]).where(F.col("total_actions") > 0)
    return _executive_output(per_org.join(organizations.select("org_id", "org_name", "industry"), "org_id"))


def _executive_output(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("org_name").alias("organization"),
        "industry",
        "total_users",
        "active_days",
        amount_to_double("amount").alias("total_credit_volume"),
        "total_actions",
        round_half_away(ratio(amount_to_double("amount"), F.col("n_amount"))).alias(
            "avg_credit_per_action"
        ),
        "primary_action_type",
        "most_active_user",
        "first_activity",
        "last_activity",
    )


# ---------------------------------------------------------------------------
# Read order of each mart (O3-O6); storage order is not a contract
# ---------------------------------------------------------------------------

def mart_order(mart_name: str) -> list[Column]:
    return {
        "customer_success_daily_activity": [
            F.desc_nulls_first("activity_date"),
            F.asc_nulls_last("org_id"),
            F.asc_nulls_last("user_id"),
        ],
        "finance_org_credit_balance": [F.asc_nulls_last("org_id")],
        "enhanced_customer_success_view": [
            F.desc_nulls_first("total_actions"),
            F.asc_nulls_last("organization"),
            F.asc_nulls_last("user_name"),
        ],
        "enhanced_finance_view": [F.desc_nulls_first("net_credit_balance")],
        "executive_summary_view": [F.desc_nulls_first("total_credit_volume")],
    }[mart_name]


def in_read_order(df: DataFrame, mart_name: str) -> DataFrame:
    return df.orderBy(*mart_order(mart_name))
