"""DuckDB SQL for every registered query, written independently of the Spark code.

The driver runs these against the same parquet tables (views ``orders``,
``customer``, ``nation``, ``region``, ``events`` ...). Each statement rebuilds
its binding with CTEs and answers the question in plain SQL: join-then-group,
window ranks for the top-1 lookups, ORDER BY + LIMIT/OFFSET for pages.
"""

from __future__ import annotations

AMOUNT = "DECIMAL(18,4)"
TOTAL = "DECIMAL(38,4)"
NUM_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)


def _org(expr: str) -> str:
    return f"'org_' || lpad(CAST({expr} AS VARCHAR), 3, '0')"


# --- bindings -------------------------------------------------------------------

B1 = f"""
b1_orgs AS (
  SELECT {_org('n_nationkey')} AS org_id, n_name AS org_name, r_name AS industry
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
b1_users AS (
  SELECT 'user_' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name,
         lower(c_name) || '@example.com' AS email, {_org('c_nationkey')} AS org_id,
         c_mktsegment AS role
  FROM customer),
b1_ua AS (
  SELECT {_org('c.c_nationkey')} AS org_id,
         'user_' || CAST(o.o_custkey AS VARCHAR) AS user_id,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'default'
              ELSE lower(o.o_orderpriority) END AS credit_type,
         CASE o.o_orderstatus WHEN 'F' THEN 'add' WHEN 'O' THEN 'deduct' WHEN 'P' THEN 'p' END AS action,
         CAST(o.o_totalprice AS DOUBLE) AS credits,
         CAST(o.o_orderdate AS TIMESTAMP) AS "timestamp",
         o.o_orderkey AS seq
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

B2 = f"""
b2_orgs AS (
  SELECT {_org('n_nationkey')} AS org_id, n_name AS org_name, r_name AS industry
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
b2_users AS (
  SELECT 'user_' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS user_name,
         lower(c_name) || '@example.com' AS email, {_org('c_nationkey')} AS org_id,
         c_mktsegment AS role
  FROM customer),
b2_ev AS (
  SELECT *, user_id % 20 AS u, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
b2_ua AS (
  SELECT {_org('u // 2')} AS org_id,
         'user_' || CAST(u AS VARCHAR) AS user_id,
         CASE WHEN k % 10 = 0 THEN 'default' ELSE 'type_' || CAST(k % 2 AS VARCHAR) END AS credit_type,
         CASE WHEN event_type = 'purchase' THEN 'add'
              WHEN event_type IN ('click', 'view') THEN 'deduct'
              WHEN event_type = 'signup' THEN NULL
              ELSE event_type END AS action,
         CAST(value AS DOUBLE) AS credits,
         CAST(ts AS TIMESTAMP) AS "timestamp",
         event_id AS seq
  FROM b2_ev)"""

B2M = f"""
b2m_ev AS (
  SELECT *, {_org('((user_id % 20) // 2 + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) % 10')} AS org,
         'user_' || CAST(user_id % 20 AS VARCHAR) AS usr,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events),
b2m_raw AS (
  SELECT
    CASE WHEN event_id % 13 = 0 THEN NULL
         WHEN event_id % 7 = 0 THEN ' ' || upper(org) || ' '
         ELSE org END AS org_id,
    CASE WHEN event_id % 17 = 0 THEN NULL
         WHEN event_id % 29 = 0 THEN usr || ' '
         ELSE usr END AS user_id,
    CASE WHEN event_id % 23 = 0 THEN NULL
         WHEN k % 10 = 0 THEN ' Default'
         ELSE 'Type_' || CAST(k % 2 AS VARCHAR) END AS credit_type,
    CASE event_type WHEN 'purchase' THEN 'ADD ' WHEN 'click' THEN 'deduct'
         WHEN 'view' THEN ' Deduct' WHEN 'signup' THEN NULL ELSE event_type END AS action,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE CAST(value AS VARCHAR) END AS credits,
    CASE event_id % 7
      WHEN 0 THEN CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR)
      WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
      WHEN 2 THEN strftime(ts, '%d-%m-%Y')
      WHEN 3 THEN strftime(ts, '%m/%d/%Y %H:%M') || CASE WHEN hour(ts) < 12 THEN ' AM' ELSE ' PM' END
      WHEN 4 THEN 'not-a-date'
      WHEN 5 THEN NULL
      ELSE '1731542400000' END AS "timestamp",
    event_id AS seq
  FROM b2m_ev)"""


def _parse(s: str) -> str:
    """Mixed timestamp text → TIMESTAMP, same rules as the Spark expression."""
    num = f"TRY_CAST(trim({s}) AS DOUBLE)"
    return f"""COALESCE(
      CASE WHEN regexp_matches({s}, '{NUM_RE}') AND {num} BETWEEN 631152000 AND 2524608000
           THEN make_timestamp(CAST({num} * 1000000 AS BIGINT)) END,
      CASE WHEN {s} = trim({s}) THEN try_strptime({s}, '%Y-%m-%d %H:%M:%S') END,
      CASE WHEN {s} = trim({s}) THEN try_strptime({s}, '%d-%m-%Y') END,
      CASE WHEN regexp_matches({s}, '\\s+[AaPp][Mm]$') AND {s} = ltrim({s})
           THEN try_strptime(regexp_replace({s}, '\\s+[AaPp][Mm]$', ''), '%m/%d/%Y %H:%M') END)"""


def _norm(c: str) -> str:
    return f"lower(regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g'))"


TYPED = f"""
b2m_typed AS (
  SELECT org_id, user_id, credit_type, action,
         CASE WHEN regexp_matches(credits, '{NUM_RE}') THEN TRY_CAST(trim(credits) AS DOUBLE) END AS credits,
         {_parse('"timestamp"')} AS "timestamp", seq
  FROM b2m_raw)"""

TYPED_NORM = f"""
b2m_typed_n AS (
  SELECT {_norm('org_id')} AS org_id, {_norm('user_id')} AS user_id,
         {_norm('credit_type')} AS credit_type, {_norm('action')} AS action,
         credits, "timestamp", seq
  FROM b2m_typed)"""


def _firsts(src: str, name: str, tie: str = "seq") -> str:
    return f"""
{name} AS (
  SELECT user_id, org_id AS first_org FROM (
    SELECT user_id, org_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ("timestamp" IS NULL), "timestamp", {tie}) AS rn
    FROM {src} WHERE user_id IS NOT NULL AND org_id IS NOT NULL)
  WHERE rn = 1)"""


def _kept(src: str, firsts: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT t.* FROM {src} t JOIN {firsts} f ON t.user_id = f.user_id
  WHERE t.org_id = f.first_org)"""


def _finish(src: str, normalise: bool, seq: bool) -> str:
    text = (lambda c: _norm(c)) if normalise else (lambda c: c)
    return f"""
  SELECT {text('org_id')} AS org_id, {text('user_id')} AS user_id,
         COALESCE({text('credit_type')}, 'default') AS credit_type,
         {text('action')} AS action,
         COALESCE(credits, 1.0) AS credits,
         COALESCE("timestamp", TIMESTAMP '1990-01-01 00:00:00') AS "timestamp"{', seq' if seq else ''}
  FROM {src}"""


CLEAN_CTES = ",".join(
    [B2M, TYPED, _firsts("b2m_typed", "b2m_first"), _kept("b2m_typed", "b2m_first", "b2m_kept")]
)
CLEAN = f"b2m_clean AS ({_finish('b2m_kept', True, True)})"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# --- mart SQL over a binding ------------------------------------------------------

SIGNED = (
    f"CASE WHEN ua.action = 'add' THEN CAST(ua.credits AS {AMOUNT}) "
    f"WHEN ua.action = 'deduct' THEN -CAST(ua.credits AS {AMOUNT}) ELSE 0 END"
)
ADDED = f"CASE WHEN ua.action = 'add' THEN CAST(ua.credits AS {AMOUNT}) ELSE 0 END"
USED = f"CASE WHEN ua.action = 'deduct' THEN CAST(ua.credits AS {AMOUNT}) ELSE 0 END"
DAY = 'CAST(ua."timestamp" AS DATE)'


def _round2(expr: str) -> str:
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(28,10)), 2) AS DOUBLE)"


def _avg_credits() -> str:
    return _round2(f"CAST(SUM(CAST(ua.credits AS {AMOUNT})) AS DOUBLE) / NULLIF(COUNT(ua.credits), 0)")


def cs_daily_sql(ua: str) -> str:
    return f"""
  SELECT {DAY} AS activity_date, ua.org_id, ua.user_id, ua.action, ua.credit_type,
         CAST(SUM(CAST(ua.credits AS {AMOUNT})) AS DOUBLE) AS total_credits_used,
         CAST(COUNT(*) AS BIGINT) AS action_count,
         CASE WHEN COUNT(*) >= 10 THEN 'High Usage' WHEN COUNT(*) >= 5 THEN 'Medium Usage'
              WHEN COUNT(*) >= 1 THEN 'Low Usage' ELSE 'No Usage' END AS usage_level
  FROM {ua} ua
  WHERE ua.user_id IS NOT NULL AND ua.org_id IS NOT NULL AND ua.action IS NOT NULL
    AND ua.credit_type != 'default'
  GROUP BY 1, 2, 3, 4, 5"""


def finance_balance_sql(ua: str) -> str:
    return f"""
  SELECT ua.org_id, CAST(SUM({SIGNED}) AS DOUBLE) AS total_credits
  FROM {ua} ua GROUP BY ua.org_id"""


def cs_user_sql(ua: str, orgs: str, users: str, as_of: str) -> str:
    return f"""
  SELECT o.org_name AS organization, o.industry, u.user_name, u.role AS user_role, u.email AS user_email,
         MIN({DAY}) AS first_activity_date, MAX({DAY}) AS last_activity_date,
         CAST(COUNT(DISTINCT {DAY}) AS BIGINT) AS active_days,
         CAST(SUM({SIGNED}) AS DOUBLE) AS net_credit_balance,
         CAST(SUM({ADDED}) AS DOUBLE) AS total_credits_purchased,
         CAST(SUM({USED}) AS DOUBLE) AS total_credits_consumed,
         CAST(COUNT(*) AS BIGINT) AS total_actions,
         CAST(COUNT(CASE WHEN ua.action = 'add' THEN 1 END) AS BIGINT) AS purchase_actions,
         CAST(COUNT(CASE WHEN ua.action = 'deduct' THEN 1 END) AS BIGINT) AS usage_actions,
         CASE WHEN COUNT(*) >= 50 THEN 'Power User' WHEN COUNT(*) >= 20 THEN 'Active User'
              WHEN COUNT(*) >= 5 THEN 'Regular User' WHEN COUNT(*) >= 1 THEN 'Light User'
              ELSE 'Inactive' END AS engagement_level,
         CASE WHEN MAX({DAY}) < CAST(DATE '{as_of}' - INTERVAL 30 DAY AS DATE) THEN 'At Risk - Inactive'
              WHEN SUM({USED}) = 0 THEN 'Not Using Credits'
              WHEN SUM({SIGNED}) < 0 THEN 'Low Balance - Upsell Opportunity'
              ELSE 'Healthy' END AS customer_status,
         {_round2(f"CAST(SUM({USED}) AS DOUBLE) / NULLIF(COUNT(DISTINCT {DAY}), 0)")} AS avg_daily_usage
  FROM {ua} ua
  JOIN {orgs} o ON ua.org_id = o.org_id
  JOIN {users} u ON ua.user_id = u.user_id
  WHERE ua.user_id IS NOT NULL AND ua.org_id IS NOT NULL AND ua.action IS NOT NULL
    AND ua.credit_type != 'default'
  GROUP BY o.org_name, o.industry, u.user_name, u.role, u.email, ua.user_id"""


def finance_mart_sql(ua: str, orgs: str) -> str:
    return f"""
  SELECT o.org_name AS organization, o.industry, o.org_id,
         CAST(SUM({SIGNED}) AS DOUBLE) AS net_credit_balance,
         CAST(SUM({ADDED}) AS DOUBLE) AS total_credits_added,
         CAST(SUM({USED}) AS DOUBLE) AS total_credits_used,
         CAST(COUNT(DISTINCT ua.user_id) AS BIGINT) AS active_users,
         CAST(COUNT(*) AS BIGINT) AS total_transactions,
         CASE WHEN SUM({SIGNED}) > 0 THEN 'In Credit - No Action Required'
              WHEN SUM({SIGNED}) < 0 THEN 'In Debit - Invoice Required'
              ELSE 'Balanced - No Action Required' END AS invoice_status,
         {_avg_credits()} AS avg_transaction_value
  FROM {ua} ua JOIN {orgs} o ON ua.org_id = o.org_id
  GROUP BY o.org_name, o.industry, o.org_id"""


def top_action_sql(ua: str) -> str:
    return f"""
  SELECT org_id, action AS primary_action_type, cnt AS primary_action_count FROM (
    SELECT ua.org_id, ua.action, CAST(COUNT(*) AS BIGINT) AS cnt,
           row_number() OVER (PARTITION BY ua.org_id ORDER BY COUNT(*) DESC, ua.action ASC NULLS FIRST) AS rn
    FROM {ua} ua GROUP BY ua.org_id, ua.action)
  WHERE rn = 1"""


def top_user_sql(ua: str, users: str) -> str:
    return f"""
  SELECT org_id, user_name AS most_active_user, cnt AS most_active_user_actions FROM (
    SELECT ua.org_id, u.user_name, CAST(COUNT(*) AS BIGINT) AS cnt,
           row_number() OVER (PARTITION BY ua.org_id ORDER BY COUNT(*) DESC, u.user_name ASC NULLS FIRST) AS rn
    FROM {ua} ua JOIN {users} u ON ua.user_id = u.user_id GROUP BY ua.org_id, u.user_name)
  WHERE rn = 1"""


def executive_sql(ua: str, orgs: str, users: str) -> str:
    return f"""
  SELECT s.organization, s.industry, s.total_users, s.active_days, s.total_credit_volume,
         s.total_actions, s.avg_credit_per_action, ta.primary_action_type, tu.most_active_user,
         s.first_activity, s.last_activity
  FROM (
    SELECT o.org_name AS organization, o.industry, o.org_id,
           CAST(COUNT(DISTINCT u.user_id) AS BIGINT) AS total_users,
           CAST(COUNT(DISTINCT {DAY}) AS BIGINT) AS active_days,
           CAST(SUM(CAST(ua.credits AS {AMOUNT})) AS DOUBLE) AS total_credit_volume,
           CAST(COUNT(*) AS BIGINT) AS total_actions,
           {_avg_credits()} AS avg_credit_per_action,
           MIN(CASE WHEN {DAY} > DATE '1990-01-01' THEN {DAY} END) AS first_activity,
           MAX({DAY}) AS last_activity
    FROM {ua} ua
    JOIN {orgs} o ON ua.org_id = o.org_id
    JOIN {users} u ON ua.user_id = u.user_id
    WHERE ua.credit_type != 'default'
    GROUP BY o.org_name, o.industry, o.org_id) s
  LEFT JOIN ({top_action_sql(ua)}) ta ON s.org_id = ta.org_id
  LEFT JOIN ({top_user_sql(ua, users)}) tu ON s.org_id = tu.org_id"""


def _b1(body: str) -> str:
    return _with(B1) + body


def _b2(body: str) -> str:
    return _with(B2) + body


def _clean(body: str, extra: tuple[str, ...] = ()) -> str:
    return _with(CLEAN_CTES, CLEAN, *extra) + body


B1_AS_OF = "2001-08-01"
B2_AS_OF = "2024-01-30"

FINANCE_COLS = [
    "organization", "industry", "org_id", "net_credit_balance", "total_credits_added",
    "total_credits_used", "active_users", "total_transactions", "invoice_status", "avg_transaction_value",
]
CS_COLS = [
    "organization", "industry", "user_name", "user_role", "user_email", "first_activity_date",
    "last_activity_date", "active_days", "net_credit_balance", "total_credits_purchased",
    "total_credits_consumed", "total_actions", "purchase_actions", "usage_actions",
    "engagement_level", "customer_status", "avg_daily_usage",
]
EXEC_COLS = [
    "organization", "industry", "total_users", "active_days", "total_credit_volume", "total_actions",
    "avg_credit_per_action", "primary_action_type", "most_active_user", "first_activity", "last_activity",
]


def _tie(cols: list[str], used: list[str]) -> str:
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols if c not in used)


def _queries() -> dict[str, str]:
    fin_b1 = finance_mart_sql("b1_ua", "b1_orgs")
    cs_b1 = cs_user_sql("b1_ua", "b1_orgs", "b1_users", B1_AS_OF)
    ex_b1 = executive_sql("b1_ua", "b1_orgs", "b1_users")
    q: dict[str, str] = {}
    q["finance_org_balance"] = _b1(finance_balance_sql("b1_ua"))
    q["finance_mart"] = _b1(fin_b1)
    q["cs_daily_activity"] = _b2(cs_daily_sql("b2_ua"))
    q["cs_daily_activity_orders"] = _b1(cs_daily_sql("b1_ua"))
    q["cs_user_mart"] = _b1(cs_b1)
    q["cs_user_mart_events"] = _b2(cs_user_sql("b2_ua", "b2_orgs", "b2_users", B2_AS_OF))
    q["finance_mart_events"] = _b2(finance_mart_sql("b2_ua", "b2_orgs"))
    q["executive_summary"] = _b1(ex_b1)
    q["executive_summary_events"] = _b2(executive_sql("b2_ua", "b2_orgs", "b2_users"))
    q["primary_action_per_org"] = _b1(top_action_sql("b1_ua"))
    q["most_active_user_per_org"] = _b1(top_user_sql("b1_ua", "b1_users"))
    q["finance_mart_from_rollup"] = _b1(fin_b1)
    q["executive_summary_from_rollup"] = _b1(ex_b1)
    # A refresh ends at what a full rebuild gives.
    for mart in ("finance_org_balance", "finance_mart", "cs_user_mart", "executive_summary"):
        q[f"{mart}_incremental"] = q[mart]
    q["cs_daily_activity_incremental"] = q["cs_daily_activity_orders"]
    q["cs_daily_activity_from_rollup"] = _b2(cs_daily_sql("b2_ua"))
    q["finance_list_page"] = _b1(
        f"SELECT * FROM ({fin_b1}) WHERE invoice_status = 'In Debit - Invoice Required'\n"
        f"  ORDER BY net_credit_balance DESC NULLS FIRST, org_id ASC NULLS FIRST, "
        f"{_tie(FINANCE_COLS, ['net_credit_balance', 'org_id'])} LIMIT 5 OFFSET 2"
    )
    q["finance_first_page"] = _b1(
        f"SELECT * FROM ({fin_b1})\n"
        f"  ORDER BY net_credit_balance DESC NULLS FIRST, org_id ASC NULLS FIRST, "
        f"{_tie(FINANCE_COLS, ['net_credit_balance', 'org_id'])} LIMIT 10"
    )
    q["cs_user_lookup"] = _b1(
        f"SELECT * FROM ({cs_b1}) WHERE organization = 'NATION_17' AND user_name = 'Customer#000000042'"
    )
    q["finance_org_lookup"] = _b1(f"SELECT * FROM ({fin_b1}) WHERE org_id = 'org_007' LIMIT 1")
    cs_used = ["total_actions", "organization", "user_name", "user_email"]
    q["cs_user_list_page"] = _b1(
        f"SELECT * FROM ({cs_b1})\n"
        f"  WHERE engagement_level = 'Regular User' AND customer_status = 'At Risk - Inactive'\n"
        f"  ORDER BY total_actions DESC NULLS FIRST, organization ASC NULLS FIRST, "
        f"user_name ASC NULLS FIRST, user_email ASC NULLS FIRST, {_tie(CS_COLS, cs_used)}\n"
        f"  LIMIT 20 OFFSET 10"
    )
    cs_order = (
        f"total_actions DESC NULLS FIRST, organization ASC NULLS FIRST, user_name ASC NULLS FIRST, "
        f"user_email ASC NULLS FIRST, {_tie(CS_COLS, cs_used)}"
    )
    q["cs_user_offset_only"] = _b1(f"SELECT * FROM ({cs_b1}) ORDER BY {cs_order} OFFSET 100")
    q["cs_user_deep_page"] = _b1(
        f"SELECT *, row_number() OVER (ORDER BY {cs_order}) - 1 AS rank FROM ({cs_b1}) ORDER BY rank LIMIT 25 OFFSET 700"
    )
    q["executive_list"] = _b1(
        f"SELECT * FROM ({ex_b1}) WHERE industry = 'ASIA'\n"
        f"  ORDER BY total_credit_volume DESC NULLS FIRST, organization ASC NULLS FIRST, "
        f"{_tie(EXEC_COLS, ['total_credit_volume', 'organization'])} LIMIT 3"
    )
    q["platform_metrics"] = _b1(
        f"""SELECT CAST(COUNT(DISTINCT organization) AS BIGINT) AS total_organizations,
         CAST(SUM(total_users) AS BIGINT) AS total_users,
         CAST(SUM(CAST(total_credit_volume AS {TOTAL})) AS DOUBLE) AS platform_credit_volume,
         CAST(SUM(CAST(avg_credit_per_action AS {TOTAL})) AS DOUBLE)
           / NULLIF(COUNT(avg_credit_per_action), 0) AS platform_avg_credit_per_action,
         CAST(COUNT(*) AS BIGINT) AS active_organizations
  FROM ({ex_b1})"""
    )
    q["industry_breakdown"] = _b1(
        f"""SELECT industry, CAST(COUNT(*) AS BIGINT) AS org_count,
         CAST(SUM(CAST(total_credit_volume AS {TOTAL})) AS DOUBLE) AS industry_volume
  FROM ({ex_b1}) GROUP BY industry"""
    )
    q["parse_mixed_timestamps"] = _with(B2M) + (
        f'SELECT seq AS event_id, "timestamp" AS raw_timestamp, {_parse(chr(34) + "timestamp" + chr(34))} '
        f"AS parsed_timestamp FROM b2m_raw"
    )
    q["normalise_and_fill"] = _with(B2M, TYPED) + _finish("b2m_typed", True, True)
    q["first_org_per_user"] = _with(B2M, TYPED, _firsts("b2m_typed", "b2m_first")) + (
        "SELECT user_id, first_org FROM b2m_first"
    )
    q["single_org_filter"] = _with(CLEAN_CTES) + (
        'SELECT org_id, user_id, credit_type, action, credits, "timestamp", seq FROM b2m_kept'
    )
    q["clean_user_actions"] = _clean("SELECT * FROM b2m_clean")
    q["clean_user_actions_normalise_first"] = _with(
        B2M, TYPED, TYPED_NORM, _firsts("b2m_typed_n", "b2m_first_n"),
        _kept("b2m_typed_n", "b2m_first_n", "b2m_kept_n"),
    ) + _finish("b2m_kept_n", False, True)
    q["clean_user_actions_rule_twice"] = _with(
        CLEAN_CTES, CLEAN, _firsts("b2m_clean", "b2m_first2", "org_id, seq"), _kept("b2m_clean", "b2m_first2", "b2m_kept2")
    ) + 'SELECT org_id, user_id, credit_type, action, credits, "timestamp", seq FROM b2m_kept2'
    q["clean_user_actions_from_csv"] = _clean(
        'SELECT org_id, user_id, credit_type, action, credits, "timestamp" FROM b2m_clean'
    )
    q["executive_summary_cleaned"] = _with(B2, CLEAN_CTES, CLEAN) + executive_sql("b2m_clean", "b2_orgs", "b2_users")
    marts = {
        "user_actions": "SELECT * FROM b2m_clean",
        "customer_success_daily_activity": cs_daily_sql("b2m_clean"),
        "finance_org_credit_balance": finance_balance_sql("b2m_clean"),
        "enhanced_customer_success_view": cs_user_sql("b2m_clean", "b2_orgs", "b2_users", B2_AS_OF),
        "enhanced_finance_view": finance_mart_sql("b2m_clean", "b2_orgs"),
        "executive_summary_view": executive_sql("b2m_clean", "b2_orgs", "b2_users"),
    }
    run_counts = "\n  UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS total_records FROM ({sql})"
        for name, sql in marts.items()
    )
    q["pipeline_run_report"] = _with(B2, CLEAN_CTES, CLEAN) + f"""
  SELECT table_name, total_records,
         CASE WHEN total_records = 0 THEN 'empty' WHEN total_records < 10 THEN 'low_count'
              ELSE 'passed' END AS verdict
  FROM ({run_counts})"""
    q["clean_user_actions_from_csv_pair"] = _with(
        B2M, TYPED, _firsts("b2m_typed", "b2m_first", "seq % 2, seq"), _kept("b2m_typed", "b2m_first", "b2m_kept"), CLEAN
    ) + 'SELECT org_id, user_id, credit_type, action, credits, "timestamp" FROM b2m_clean'
    q["csv_scan_report"] = """
  SELECT export, CAST(COUNT(*) AS BIGINT) AS records, CAST(0 AS BIGINT) AS short_rows,
         CAST(COUNT(*) FILTER (WHERE export = 'c' AND event_id % 100 = 0) AS BIGINT) AS long_rows, FALSE AS unbalanced
  FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS export FROM events
        UNION ALL SELECT event_id, 'c' FROM events WHERE event_id % 50 = 0)
  GROUP BY export"""
    b3 = """
b3 AS (
  SELECT 'org_' || lpad(CAST(o_orderkey % 7 AS VARCHAR), 3, '0') AS org_id,
         'user_' || CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS user_id,
         lower(o_orderpriority) AS credit_type, CASE WHEN o_orderstatus = 'F' THEN 'add' ELSE 'deduct' END AS action,
         CAST(o_totalprice AS DOUBLE) AS credits, CAST(o_orderdate AS TIMESTAMP) AS "timestamp", o_orderkey AS seq
  FROM orders)"""
    q["first_org_per_user_orders"] = _with(b3, _firsts("b3", "b3_first")) + "SELECT user_id, first_org FROM b3_first"
    q["single_org_filter_hot_user"] = _with(b3, _firsts("b3", "b3_first"), _kept("b3", "b3_first", "b3_kept")) + (
        'SELECT org_id, user_id, credit_type, action, credits, "timestamp", seq FROM b3_kept'
    )
    q["cleaning_report"] = _with(B2M, TYPED, _firsts("b2m_typed", "b2m_first")) + """
  SELECT CAST(COUNT(*) AS BIGINT) AS rows_in,
         CAST(COUNT(*) FILTER (WHERE t.org_id IS NULL AND t.user_id IS NULL) AS BIGINT) AS dropped_missing_ids,
         CAST(COUNT(*) FILTER (WHERE NOT (t.org_id IS NULL AND t.user_id IS NULL)
                               AND NOT COALESCE(t.org_id = f.first_org, FALSE)) AS BIGINT) AS dropped_org_rule,
         CAST(COUNT(*) FILTER (WHERE t.org_id IS NULL AND t.user_id IS NOT NULL) AS BIGINT) AS dropped_org_missing,
         CAST(COUNT(*) FILTER (WHERE t.user_id IS NULL AND t.org_id IS NOT NULL) AS BIGINT) AS dropped_user_missing,
         CAST(COUNT(*) FILTER (WHERE t.org_id IS NOT NULL AND t.user_id IS NOT NULL
                               AND t.org_id <> f.first_org) AS BIGINT) AS dropped_other_org,
         CAST(COUNT(*) FILTER (WHERE COALESCE(t.org_id = f.first_org, FALSE)) AS BIGINT) AS rows_out
  FROM b2m_typed t LEFT JOIN b2m_first f ON t.user_id = f.user_id"""
    q["cleaning_report_observed"] = q["cleaning_report"]
    q["finance_mart_cleaned"] = _with(B2, CLEAN_CTES, CLEAN) + finance_mart_sql("b2m_clean", "b2_orgs")
    q["distinct_ids"] = _clean(
        "SELECT DISTINCT 'org_id' AS id_column, org_id AS id_value FROM b2m_clean\n"
        "UNION ALL SELECT DISTINCT 'user_id' AS id_column, user_id AS id_value FROM b2m_clean"
    )
    q["distinct_id_counts"] = _clean(
        "SELECT 'org_id' AS id_column, CAST(COUNT(DISTINCT org_id) + MAX(CASE WHEN org_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_distinct FROM b2m_clean\n"
        "UNION ALL SELECT 'user_id', CAST(COUNT(DISTINCT user_id) + MAX(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM b2m_clean"
    )
    q["dedup_actions"] = _clean(
        """SELECT org_id, user_id, credit_type, action, credits, "timestamp", seq FROM (
    SELECT *, row_number() OVER (PARTITION BY org_id, user_id, credit_type, "timestamp" ORDER BY seq) AS rn
    FROM b2m_clean) WHERE rn = 1"""
    )
    q["duplicate_keys"] = _clean(
        """SELECT org_id, user_id, credit_type, "timestamp", CAST(COUNT(*) AS BIGINT) AS occurrences
  FROM b2m_clean GROUP BY org_id, user_id, credit_type, "timestamp" HAVING COUNT(*) > 1"""
    )
    tables = {
        "user_actions": "SELECT * FROM b1_ua",
        "customer_success_daily_activity": cs_daily_sql("b1_ua"),
        "finance_org_credit_balance": finance_balance_sql("b1_ua"),
        "enhanced_customer_success_view": cs_b1,
        "enhanced_finance_view": fin_b1,
        "executive_summary_view": ex_b1,
        "organizations_events": "SELECT * FROM b2_orgs",
    }
    counts = "\n  UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(COUNT(*) AS BIGINT) AS total_records FROM ({sql})"
        for name, sql in tables.items()
    )
    q["table_check"] = _with(B1, B2) + f"""
  SELECT table_name, total_records,
         CASE WHEN total_records = 0 THEN 'empty' WHEN total_records < 10 THEN 'low_count'
              ELSE 'passed' END AS verdict
  FROM ({counts})"""
    q["null_violations"] = _with(B1, CLEAN_CTES, CLEAN) + """
  SELECT 'raw_actions' AS table_name, 'not_null' AS check_name, 'org_id' AS column_name,
         CAST(COUNT(*) FILTER (WHERE org_id IS NULL) AS BIGINT) AS violations FROM b2m_raw
  UNION ALL SELECT 'raw_actions', 'not_null', 'user_id', CAST(COUNT(*) FILTER (WHERE user_id IS NULL) AS BIGINT) FROM b2m_raw
  UNION ALL SELECT 'raw_actions', 'primary_key', 'user_id', CAST(COUNT(*) - COUNT(DISTINCT coalesce(user_id, chr(1))) AS BIGINT) FROM b2m_raw
  UNION ALL SELECT 'user_actions', 'not_null', 'org_id', CAST(COUNT(*) FILTER (WHERE org_id IS NULL) AS BIGINT) FROM b2m_clean
  UNION ALL SELECT 'user_actions', 'not_null', 'user_id', CAST(COUNT(*) FILTER (WHERE user_id IS NULL) AS BIGINT) FROM b2m_clean
  UNION ALL SELECT 'organizations', 'not_null', 'org_id', CAST(COUNT(*) FILTER (WHERE org_id IS NULL) AS BIGINT) FROM b1_orgs
  UNION ALL SELECT 'organizations', 'not_null', 'org_name', CAST(COUNT(*) FILTER (WHERE org_name IS NULL) AS BIGINT) FROM b1_orgs
  UNION ALL SELECT 'organizations', 'primary_key', 'org_id', CAST(COUNT(*) - COUNT(DISTINCT org_id) AS BIGINT) FROM b1_orgs
  UNION ALL SELECT 'users', 'not_null', 'user_id', CAST(COUNT(*) FILTER (WHERE user_id IS NULL) AS BIGINT) FROM b1_users
  UNION ALL SELECT 'users', 'not_null', 'user_name', CAST(COUNT(*) FILTER (WHERE user_name IS NULL) AS BIGINT) FROM b1_users
  UNION ALL SELECT 'users', 'primary_key', 'user_id', CAST(COUNT(*) - COUNT(DISTINCT user_id) AS BIGINT) FROM b1_users"""
    q["orphan_users"] = _b2(
        """SELECT u.org_id, u.user_id, u.user_name, u.email, u.role FROM b2_users u
  WHERE u.org_id IS NOT NULL AND u.org_id NOT IN (SELECT org_id FROM b2_orgs WHERE industry <> 'ASIA')"""
    )
    return q


ORACLE_SQL = _queries()
