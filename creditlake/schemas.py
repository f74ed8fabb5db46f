"""Table contracts and the fixed business constants of the credit ledger.

Everything that must equal the original job's values for equal results is kept
together in the "fixed values" block below, in natural order, as plain text.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as written for results to match)
# ---------------------------------------------------------------------------

# Cell texts that the pandas CSV reader turns into a missing value by default.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Epoch-second timestamps are accepted only inside this closed range.
EPOCH_RANGE_START = "1990-01-01 00:00:00"
EPOCH_RANGE_END = "2050-01-01 00:00:00"
EPOCH_MIN_SECONDS = 631152000  # 1990-01-01T00:00:00Z
EPOCH_MAX_SECONDS = 2524608000  # 2050-01-01T00:00:00Z

# Text timestamp shapes, tried in this order after the epoch path.
ISO_PATTERN = "yyyy-M-d H:m:s"  # %Y-%m-%d %H:%M:%S
EU_PATTERN = "d-M-yyyy"  # %d-%m-%Y
US_PATTERN = "M/d/yyyy H:m"  # %m/%d/%Y %H:%M %p, with %p read but not applied
US_PATTERN_MERIDIEM = "M/d/yyyy h:m a"  # optional: honour AM/PM

# Fill values used by the cleaning step.
SENTINEL_TIMESTAMP = "1990-01-01 00:00:00"
SENTINEL_DATE = "1990-01-01"
DEFAULT_CREDITS = 1.0
DEFAULT_CREDIT_TYPE = "default"

# Action names.
ACTION_ADD = "add"
ACTION_DEDUCT = "deduct"

# usage_level of the daily activity mart: (minimum action_count, label), first match wins.
USAGE_LEVELS = ((10, "High Usage"), (5, "Medium Usage"), (1, "Low Usage"))
USAGE_LEVEL_ELSE = "No Usage"

# engagement_level of the per-user mart: (minimum total_actions, label), first match wins.
ENGAGEMENT_LEVELS = ((50, "Power User"), (20, "Active User"), (5, "Regular User"), (1, "Light User"))
ENGAGEMENT_LEVEL_ELSE = "Inactive"

# customer_status of the per-user mart, first match wins.
STATUS_AT_RISK = "At Risk - Inactive"
STATUS_NOT_USING = "Not Using Credits"
STATUS_LOW_BALANCE = "Low Balance - Upsell Opportunity"
STATUS_HEALTHY = "Healthy"
INACTIVE_AFTER_DAYS = 30

# invoice_status of the finance mart.
INVOICE_IN_CREDIT = "In Credit - No Action Required"
INVOICE_IN_DEBIT = "In Debit - Invoice Required"
INVOICE_BALANCED = "Balanced - No Action Required"

# Page size limits of the serving queries.
FINANCE_MAX_LIMIT = 100
CUSTOMER_SUCCESS_MAX_LIMIT = 100
EXECUTIVE_MAX_LIMIT = 50

# Row-count verdicts of the table checks.
LOW_COUNT_BELOW = 10
VERDICT_EMPTY = "empty"
VERDICT_LOW = "low_count"
VERDICT_PASSED = "passed"

# ---------------------------------------------------------------------------
# Numeric representation
# ---------------------------------------------------------------------------

# Credits are summed exactly as integer units of 10^-AMOUNT_SCALE credits and
# exposed as double afterwards, so sums do not depend on row order or partitioning.
AMOUNT_SCALE = 4
UNITS_TOTAL_TYPE = T.DecimalType(38, 0)
# Scale used before rounding an average to two places (half away from zero).
ROUNDING_TYPE = T.DecimalType(28, 10)

# ---------------------------------------------------------------------------
# Table contracts
# ---------------------------------------------------------------------------

FACT_COLUMNS = ("org_id", "user_id", "credit_type", "action", "credits", "timestamp")
RAW_TEXT_COLUMNS = ("org_id", "user_id", "credit_type", "action")

USER_ACTIONS = T.StructType(
    [
        T.StructField("org_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("credit_type", T.StringType(), True),
        T.StructField("action", T.StringType(), True),
        T.StructField("credits", T.DoubleType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)

RAW_ACTIONS = T.StructType([T.StructField(c, T.StringType(), True) for c in FACT_COLUMNS])

ORGANIZATIONS = T.StructType(
    [
        T.StructField("org_id", T.StringType(), False),
        T.StructField("org_name", T.StringType(), False),
        T.StructField("industry", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType(), False),
        T.StructField("user_name", T.StringType(), False),
        T.StructField("email", T.StringType(), True),
        T.StructField("org_id", T.StringType(), True),
        T.StructField("role", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)


_SIMPLE_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def _fields(spec: str) -> T.StructType:
    """Build a nullable StructType from 'name type, name type' text (no session needed)."""
    pairs = [item.split() for item in spec.split(",")]
    return T.StructType([T.StructField(name, _SIMPLE_TYPES[kind], True) for name, kind in pairs])


CS_DAILY_ACTIVITY = _fields(
    "activity_date date, org_id string, user_id string, action string, credit_type string, "
    "total_credits_used double, action_count bigint, usage_level string"
)
FINANCE_ORG_BALANCE = _fields("org_id string, total_credits double")
CS_USER_MART = _fields(
    "organization string, industry string, user_name string, user_role string, user_email string, "
    "first_activity_date date, last_activity_date date, active_days bigint, "
    "net_credit_balance double, total_credits_purchased double, total_credits_consumed double, "
    "total_actions bigint, purchase_actions bigint, usage_actions bigint, "
    "engagement_level string, customer_status string, avg_daily_usage double"
)
FINANCE_MART = _fields(
    "organization string, industry string, org_id string, net_credit_balance double, "
    "total_credits_added double, total_credits_used double, active_users bigint, "
    "total_transactions bigint, invoice_status string, avg_transaction_value double"
)
EXECUTIVE_SUMMARY = _fields(
    "organization string, industry string, total_users bigint, active_days bigint, "
    "total_credit_volume double, total_actions bigint, avg_credit_per_action double, "
    "primary_action_type string, most_active_user string, first_activity date, last_activity date"
)
PLATFORM_METRICS = _fields(
    "total_organizations bigint, total_users bigint, platform_credit_volume double, "
    "platform_avg_credit_per_action double, active_organizations bigint"
)
INDUSTRY_BREAKDOWN = _fields("industry string, org_count bigint, industry_volume double")

# Unique keys declared for the marts (checked before a mart is published).
MART_KEYS = {
    "customer_success_daily_activity": ("activity_date", "org_id", "user_id", "action", "credit_type"),
    "finance_org_credit_balance": ("org_id",),
    "enhanced_finance_view": ("org_id",),
}

MART_CONTRACTS = {
    "customer_success_daily_activity": CS_DAILY_ACTIVITY,
    "finance_org_credit_balance": FINANCE_ORG_BALANCE,
    "enhanced_customer_success_view": CS_USER_MART,
    "enhanced_finance_view": FINANCE_MART,
    "executive_summary_view": EXECUTIVE_SUMMARY,
}

# Columns that a served row must have (P12): all but the optional ones. Checked while a mart is written.
SERVED_OPTIONAL = {"enhanced_customer_success_view": ("avg_daily_usage",)}
MART_NOT_NULL = {
    name: tuple(f.name for f in MART_CONTRACTS[name].fields if f.name not in SERVED_OPTIONAL.get(name, ()))
    for name in ("enhanced_customer_success_view", "enhanced_finance_view", "executive_summary_view")
}
