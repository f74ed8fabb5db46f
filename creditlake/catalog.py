"""Named queries over the driver tables: one per operator family.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Timestamps
are returned as ``timestamp_ntz`` so results do not depend on the session zone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from creditlake.operators import clean as C
from creditlake.operators import explore as X
from creditlake.operators import marts as M
from creditlake.operators import quality as Q
from creditlake.operators import serve as S
from creditlake.plans.incremental import incremental_marts
from creditlake.plans.materialize import materialize
from creditlake.plans.publish import run
from creditlake.schemas import INVOICE_IN_DEBIT
from creditlake.session import checkpoint_dir
from creditlake.sources import bindings as B
from creditlake.operators.ranked import RANK, store_ranked
from creditlake.sources.csv import read_raw_actions, scan_actions

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the serving queries (fixed so both engines answer the same question).
FINANCE_PAGE = {"invoice_status": INVOICE_IN_DEBIT, "limit": 5, "offset": 2}
LOOKUP_ORG = "org_007"
CS_PAGE = {"engagement_level": "Regular User", "customer_status": "At Risk - Inactive", "limit": 20, "offset": 10}
EXECUTIVE_PAGE = {"industry": "ASIA", "limit": 3}
FINANCE_FIRST_PAGE = {"limit": 10}
CS_OFFSET = 100
CS_DEEP_PAGE = {"limit": 25, "offset": 700}
B3_HOT_ROWS = 500
CS_LOOKUP = {"organization": "NATION_17", "user": "Customer#000000042"}


def _ntz(df: DataFrame) -> DataFrame:
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


# --- marts on B1 (orders) ----------------------------------------------------


def finance_org_balance(spark, sf_dir):
    return M.finance_org_balance(B.orders_ledger(spark, sf_dir).actions)


def finance_mart(spark, sf_dir):
    b = B.orders_ledger(spark, sf_dir)
    return M.finance_mart(b.actions, b.organizations)


def cs_user_mart(spark, sf_dir):
    b = B.orders_ledger(spark, sf_dir)
    return M.cs_user_mart(b.actions, b.organizations, b.users, b.as_of)


def executive_summary(spark, sf_dir):
    b = B.orders_ledger(spark, sf_dir)
    return M.executive_summary(b.actions, b.organizations, b.users)


def cs_daily_activity_orders(spark, sf_dir):
    return M.cs_daily_activity(B.orders_ledger(spark, sf_dir).actions)


def primary_action_per_org(spark, sf_dir):
    return M.primary_action_per_org(B.orders_ledger(spark, sf_dir).actions)


def most_active_user_per_org(spark, sf_dir):
    b = B.orders_ledger(spark, sf_dir)
    return M.most_active_user_per_org(b.actions, b.users)


def finance_mart_from_rollup(spark, sf_dir):
    """Finance mart built from the stored-rollup path (daily rollup, then mart)."""
    b = B.orders_ledger(spark, sf_dir)
    return M.finance_mart(M.daily_rollup(b.actions), b.organizations)


def executive_summary_from_rollup(spark, sf_dir):
    """Executive mart over the daily rollup (the input run() gives it)."""
    b = B.orders_ledger(spark, sf_dir)
    return M.executive_summary(M.daily_rollup(b.actions), b.organizations, b.users, materialize=False)


# --- marts on B2 (events): reaches every usage label ---------------------------


def cs_daily_activity(spark, sf_dir):
    return M.cs_daily_activity(B.events_ledger(spark, sf_dir).actions)


def cs_daily_activity_from_rollup(spark, sf_dir):
    """Daily mart as a projection of the daily rollup (the run() path)."""
    rollup = M.daily_rollup(B.events_ledger(spark, sf_dir).actions)
    return M.cs_daily_activity(rollup, rolled_up=True)


def cs_user_mart_events(spark, sf_dir):
    b = B.events_ledger(spark, sf_dir)
    return M.cs_user_mart(b.actions, b.organizations, b.users, b.as_of)


def finance_mart_events(spark, sf_dir):
    b = B.events_ledger(spark, sf_dir)
    return M.finance_mart(b.actions, b.organizations)


def executive_summary_events(spark, sf_dir):
    b = B.events_ledger(spark, sf_dir)
    return M.executive_summary(b.actions, b.organizations, b.users)


# --- serving ------------------------------------------------------------------


def finance_list_page(spark, sf_dir):
    return S.finance_page(finance_mart(spark, sf_dir), **FINANCE_PAGE)


def finance_first_page(spark, sf_dir):
    return S.finance_page(finance_mart(spark, sf_dir), **FINANCE_FIRST_PAGE)


def cs_user_lookup(spark, sf_dir):
    return S.customer_success_page(cs_user_mart(spark, sf_dir), **CS_LOOKUP)


def finance_org_lookup(spark, sf_dir):
    return S.finance_lookup(finance_mart(spark, sf_dir), LOOKUP_ORG)


def cs_user_list_page(spark, sf_dir):
    return S.customer_success_page(cs_user_mart(spark, sf_dir), **CS_PAGE)


def cs_user_offset_only(spark, sf_dir):
    """Offset without a limit: all rows from the offset on, by the rank directory."""
    return S.customer_success_page(cs_user_mart(spark, sf_dir), offset=CS_OFFSET)


def cs_user_deep_page(spark, sf_dir):
    """A page far down a stored ranking, with the rows' ranks from 0."""
    mart = cs_user_mart(spark, sf_dir)
    page = store_ranked(mart, S.customer_success_order(mart)).page(**CS_DEEP_PAGE, with_rank=True)
    return page.withColumnRenamed(RANK, "rank")


def executive_list(spark, sf_dir):
    return S.executive_page(executive_summary(spark, sf_dir), **EXECUTIVE_PAGE)


def platform_metrics(spark, sf_dir):
    return S.platform_metrics(executive_summary(spark, sf_dir))


def industry_breakdown(spark, sf_dir):
    return S.industry_breakdown(executive_summary(spark, sf_dir))


# --- cleaning on B2m (messy events) ------------------------------------------


def parse_mixed_timestamps(spark, sf_dir):
    raw = B.messy_events(spark, sf_dir)
    return _ntz(
        raw.select(
            F.col("seq").alias("event_id"),
            F.col("timestamp").alias("raw_timestamp"),
            C.parse_mixed_timestamp(F.col("timestamp")).alias("parsed_timestamp"),
        )
    )


def normalise_and_fill(spark, sf_dir):
    return _ntz(C.normalise_and_fill(B.messy_events(spark, sf_dir)))


def first_org_per_user(spark, sf_dir):
    return C.first_org_per_user(C.prepare(B.messy_events(spark, sf_dir)))


def single_org_filter(spark, sf_dir):
    return _ntz(C.single_org_filter(C.prepare(B.messy_events(spark, sf_dir))))


def _clean(spark, sf_dir, keep_seq=False):
    return C.clean(B.messy_events(spark, sf_dir), keep_seq=keep_seq)


def clean_user_actions(spark, sf_dir):
    return _ntz(_clean(spark, sf_dir, keep_seq=True))


def clean_user_actions_normalise_first(spark, sf_dir):
    raw = B.messy_events(spark, sf_dir)
    return _ntz(C.clean(raw, C.CleanOptions(normalise_first=True), keep_seq=True))


def _messy_csv(spark, sf_dir) -> str:
    """The messy rows exported as CSV (in file order) to the shared stage folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/creditlake-csv-{uuid.uuid4().hex}"
    (
        B.messy_events(spark, sf_dir)
        .orderBy("seq")
        .drop("seq")
        .write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def _messy_csv_pair(spark, sf_dir) -> list[str]:
    """Three exports: even events; odd ones with other columns and line ends in quoted fields; a few with too many fields."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/creditlake-csv-{uuid.uuid4().hex}"
    rows = B.messy_events(spark, sf_dir)
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"'}
    rows.where("seq % 2 = 0").orderBy("seq").drop("seq").write.options(**keep).csv(f"{folder}/a")
    note = F.when(F.col("seq") % 5 == 1, F.concat(F.lit('says "no",\nor '), F.col("seq").cast("string"), F.lit("\n\nnot")))
    turned = ["timestamp", "credits", "notes", "action", "credit_type", "user_id", "org_id"]
    rows.withColumn("notes", note).where("seq % 2 = 1").orderBy("seq").select(turned).write.options(**keep).csv(f"{folder}/b")
    long = rows.where("seq % 50 = 0").withColumn("timestamp", F.when(F.col("seq") % 100 == 0, F.lit("x,y")).otherwise(F.lit("x")))
    long.drop("seq").write.options(**{**keep, "quote": ""}).csv(f"{folder}/c")
    return [f"{folder}/a", f"{folder}/b", f"{folder}/c"]


def clean_user_actions_from_csv_pair(spark, sf_dir):
    """S1 over files of two headers, one with records that span lines: scanned in blocks, cleaned."""
    return _ntz(C.clean(read_raw_actions(spark, _messy_csv_pair(spark, sf_dir)[:2])))


def csv_scan_report(spark, sf_dir):
    """Records and rows of a wrong width of the three exports."""
    report = scan_actions(spark, _messy_csv_pair(spark, sf_dir)).report()
    counts = [F.sum(c).alias(c) for c in ("records", "short_rows", "long_rows")]
    export = F.regexp_extract("file", "/([abc])/[^/]*$", 1).alias("export")
    return report.groupBy(export).agg(*counts, F.max("unbalanced").alias("unbalanced"))


def first_org_per_user_orders(spark, sf_dir):
    return C.first_org_per_user(C.prepare(B.hot_user_orders(spark, sf_dir)))


def single_org_filter_hot_user(spark, sf_dir):
    """The rule where one user has a third of the rows and the join back shuffles, with salts."""
    typed = C.prepare(B.hot_user_orders(spark, sf_dir))
    return _ntz(C.single_org_filter(typed, hot_rows=B3_HOT_ROWS, strategy="shuffle_hash"))


def clean_user_actions_rule_twice(spark, sf_dir):
    """The notebook variant: the single-organisation rule again after normalising."""
    raw = B.messy_events(spark, sf_dir)
    return _ntz(C.clean(raw, C.CleanOptions(rule_again_after_normalise=True), keep_seq=True))


def clean_user_actions_from_csv(spark, sf_dir):
    """S1 end to end: the messy rows exported as CSV, scanned back, cleaned."""
    return _ntz(C.clean(read_raw_actions(spark, _messy_csv(spark, sf_dir))))


PIPELINE_DATABASE = "creditlake_registry"


def pipeline_run_report(spark, sf_dir):
    """The whole refresh (S3, S9-S12): CSV → dimensions → fact → rollup → five marts.

    Tables are published into their own database inside the shared stage
    folder; the result is the table report of the run.
    """
    location = f"{checkpoint_dir(spark).rstrip('/')}/{PIPELINE_DATABASE}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {PIPELINE_DATABASE} LOCATION '{location}'")
    dims = B.events_ledger(spark, sf_dir)
    result = run(
        spark, _messy_csv(spark, sf_dir), dims.organizations, dims.users,
        as_of=dims.as_of, database=PIPELINE_DATABASE,
    )
    return result.report


def cleaning_report_observed(spark, sf_dir):
    """Q7 as a run reports it: the messy CSV cleaned and stored once, with its counts observed on the way."""
    counts = Observation(f"cleaning_{uuid.uuid4().hex}")
    raw = read_raw_actions(spark, _messy_csv(spark, sf_dir))
    stored = materialize(C.clean(raw, counts=counts), "cleaned")
    report = C.observed_report(counts, stored.count(), raw)
    columns = [c for c in report if not c.startswith("unparsed")]
    return spark.createDataFrame([tuple(report[c] for c in columns)], ", ".join(f"{c} long" for c in columns))


def cleaning_report(spark, sf_dir):
    return C.cleaning_report(B.messy_events(spark, sf_dir))


def finance_mart_cleaned(spark, sf_dir):
    """Finance mart over the cleaned messy fact (cleaning → mart end to end)."""
    b = B.messy_events_ledger(spark, sf_dir)
    return M.finance_mart(C.clean(b.actions), b.organizations)


def executive_summary_cleaned(spark, sf_dir):
    """Executive mart over the cleaned messy fact (sentinel dates present)."""
    b = B.messy_events_ledger(spark, sf_dir)
    return M.executive_summary(C.clean(b.actions), b.organizations, b.users)


# --- incremental refresh (S11) ---------------------------------------------------


def _refreshed_orders(spark, sf_dir) -> dict[str, DataFrame]:
    """The five marts after a first load of the orders up to 1996, those of odd months with
    wrong credits and actions, and a refresh that replaces these days and adds the later ones."""
    b = B.orders_ledger(spark, sf_dir)
    day = F.col("timestamp")
    late, odd = F.year(day) >= 1997, F.month(day) % 2 == 1
    wrong = b.actions.withColumns(
        {
            "credits": F.when(odd, F.col("credits") * 2 + 1).otherwise(F.col("credits")),
            "action": F.when(odd, F.lit("add")).otherwise(F.col("action")),
        }
    )
    store = incremental_marts(spark, parts=8, period="year")
    store.refresh(wrong.where(~late))
    store.refresh(b.actions.where(late | odd))
    return store.marts(b.organizations, b.users, b.as_of)


def cs_daily_activity_incremental(spark, sf_dir):
    return _refreshed_orders(spark, sf_dir)["customer_success_daily_activity"]


def finance_org_balance_incremental(spark, sf_dir):
    return _refreshed_orders(spark, sf_dir)["finance_org_credit_balance"]


def cs_user_mart_incremental(spark, sf_dir):
    return _refreshed_orders(spark, sf_dir)["enhanced_customer_success_view"]


def finance_mart_incremental(spark, sf_dir):
    return _refreshed_orders(spark, sf_dir)["enhanced_finance_view"]


def executive_summary_incremental(spark, sf_dir):
    return _refreshed_orders(spark, sf_dir)["executive_summary_view"]


# --- exploration and quality ---------------------------------------------------


def distinct_ids(spark, sf_dir):
    return X.distinct_ids(_clean(spark, sf_dir))


def distinct_id_counts(spark, sf_dir):
    return X.distinct_id_counts(_clean(spark, sf_dir))


def dedup_actions(spark, sf_dir):
    """A21 through the cleaning flag (off by default in the pipeline)."""
    raw = B.messy_events(spark, sf_dir)
    return _ntz(C.clean(raw, C.CleanOptions(dedup=True), keep_seq=True))


def duplicate_keys(spark, sf_dir):
    return _ntz(Q.duplicate_keys(_clean(spark, sf_dir), X.DEDUP_KEYS))


def table_check(spark, sf_dir):
    b = B.orders_ledger(spark, sf_dir)
    tables = {
        "user_actions": b.actions,
        "customer_success_daily_activity": M.cs_daily_activity(b.actions),
        "finance_org_credit_balance": M.finance_org_balance(b.actions),
        "enhanced_customer_success_view": M.cs_user_mart(b.actions, b.organizations, b.users, b.as_of),
        "enhanced_finance_view": M.finance_mart(b.actions, b.organizations),
        "executive_summary_view": M.executive_summary(b.actions, b.organizations, b.users),
        "organizations_events": B.events_ledger(spark, sf_dir).organizations,
    }
    return Q.table_check(tables)


def null_violations(spark, sf_dir):
    b = B.orders_ledger(spark, sf_dir)
    raw = Q.null_violations("raw_actions", B.messy_events(spark, sf_dir), ["org_id", "user_id"], ["user_id"])
    fact = Q.null_violations("user_actions", _clean(spark, sf_dir), ["org_id", "user_id"])
    orgs = Q.null_violations("organizations", b.organizations, ["org_id", "org_name"], ["org_id"])
    users = Q.null_violations("users", b.users, ["user_id", "user_name"], ["user_id"])
    return raw.unionByName(fact).unionByName(orgs).unionByName(users)


def orphan_users(spark, sf_dir):
    """Against a dimension that lacks one industry's organisations, so that there are orphans to find."""
    b = B.events_ledger(spark, sf_dir)
    known = b.organizations.where("industry <> 'ASIA'")
    return _ntz(Q.orphan_users(b.users, known).drop("created_at"))


QUERIES: dict[str, Query] = {
    "finance_org_balance": finance_org_balance,
    "finance_mart": finance_mart,
    "cs_daily_activity": cs_daily_activity,
    "cs_daily_activity_orders": cs_daily_activity_orders,
    "cs_daily_activity_from_rollup": cs_daily_activity_from_rollup,
    "cs_user_mart": cs_user_mart,
    "cs_user_mart_events": cs_user_mart_events,
    "finance_mart_events": finance_mart_events,
    "executive_summary": executive_summary,
    "executive_summary_events": executive_summary_events,
    "executive_summary_from_rollup": executive_summary_from_rollup,
    "primary_action_per_org": primary_action_per_org,
    "most_active_user_per_org": most_active_user_per_org,
    "finance_mart_from_rollup": finance_mart_from_rollup,
    "finance_list_page": finance_list_page,
    "finance_first_page": finance_first_page,
    "finance_org_lookup": finance_org_lookup,
    "cs_user_list_page": cs_user_list_page,
    "cs_user_lookup": cs_user_lookup,
    "cs_user_offset_only": cs_user_offset_only,
    "cs_user_deep_page": cs_user_deep_page,
    "executive_list": executive_list,
    "platform_metrics": platform_metrics,
    "industry_breakdown": industry_breakdown,
    "parse_mixed_timestamps": parse_mixed_timestamps,
    "normalise_and_fill": normalise_and_fill,
    "first_org_per_user": first_org_per_user,
    "single_org_filter": single_org_filter,
    "clean_user_actions": clean_user_actions,
    "clean_user_actions_normalise_first": clean_user_actions_normalise_first,
    "clean_user_actions_rule_twice": clean_user_actions_rule_twice,
    "clean_user_actions_from_csv": clean_user_actions_from_csv,
    "clean_user_actions_from_csv_pair": clean_user_actions_from_csv_pair,
    "csv_scan_report": csv_scan_report,
    "first_org_per_user_orders": first_org_per_user_orders,
    "single_org_filter_hot_user": single_org_filter_hot_user,
    "cleaning_report": cleaning_report,
    "cleaning_report_observed": cleaning_report_observed,
    "pipeline_run_report": pipeline_run_report,
    "finance_mart_cleaned": finance_mart_cleaned,
    "executive_summary_cleaned": executive_summary_cleaned,
    "cs_daily_activity_incremental": cs_daily_activity_incremental,
    "finance_org_balance_incremental": finance_org_balance_incremental,
    "cs_user_mart_incremental": cs_user_mart_incremental,
    "finance_mart_incremental": finance_mart_incremental,
    "executive_summary_incremental": executive_summary_incremental,
    "distinct_ids": distinct_ids,
    "distinct_id_counts": distinct_id_counts,
    "dedup_actions": dedup_actions,
    "duplicate_keys": duplicate_keys,
    "table_check": table_check,
    "null_violations": null_violations,
    "orphan_users": orphan_users,
}
