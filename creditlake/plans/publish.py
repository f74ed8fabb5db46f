"""Publishing tables and the end-to-end refresh.

``publish`` writes a result as a new immutable version table, checks it (schema
contract, NOT NULL columns, unique keys) while readers still see the previous
version, then repoints the view ``name`` at it. The swap is a catalog update:
no data is renamed or copied (a rename on an object store is a full copy). The
previous version is kept for queries already running; older ones are dropped.
Written tables are also the lineage cuts of the pipeline: every stage reads the
previous stage's stored table, so a lost executor only reruns the current stage.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.operators import marts as M
from creditlake.operators.clean import CleanOptions, clean, observed_report
from creditlake.operators.quality import (
    DataQualityError,
    assert_no_rows,
    assert_schema,
    duplicate_keys,
    orphan_users,
    table_check,
)
from creditlake.plans.materialize import stage_scope
from creditlake.schemas import MART_CONTRACTS, MART_KEYS, MART_NOT_NULL, ORGANIZATIONS, USER_ACTIONS, USERS
from creditlake.sources.csv import read_raw_actions
from creditlake.sources.dimensions import organizations_from, users_from

FACT_TABLE = "user_actions"
ROLLUP_TABLE = "user_actions_daily"
MART_NAMES = tuple(MART_CONTRACTS)


def _qualified(name: str, database: str | None) -> str:
    return f"{database}.{name}" if database else name


def _versions(spark: SparkSession, name: str, database: str | None) -> list[str]:
    version = re.compile(rf"{re.escape(name.lower())}__v[0-9]{{20}}_[0-9a-f]{{6}}")
    tables = spark.catalog.listTables(dbName=database) if database else spark.catalog.listTables()
    return sorted(t.name for t in tables if version.fullmatch(t.name.lower()) and not t.isTemporary)


def _is_view(spark: SparkSession, target: str) -> bool:
    return spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType == "VIEW"


def publish(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    database: str | None = None,
    contract: T.StructType | None = None,
    not_null: Sequence[str] = (),
    unique_keys: Sequence[str] = (),
    sort_within: Sequence[str] = (),
    keep_versions: int = 2,
) -> DataFrame:
    """Write ``df`` as a new version of ``name`` after checking it; return the published view."""
    target = _qualified(name, database)
    version_name = f"{name}__v{time.time_ns():020d}_{uuid.uuid4().hex[:6]}"
    version = _qualified(version_name, database)
    if contract is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in contract.fields])
    if sort_within:  # ranges over the cluster, so that each file covers few keys
        df = df.repartitionByRange(*sort_within).sortWithinPartitions(*sort_within)
    nulls = None
    if not_null:  # counted while writing: no second pass over the data
        nulls = Observation(f"not_null_{version_name}")
        df = df.observe(nulls, *[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    df.write.mode("errorifexists").format("parquet").saveAsTable(version)
    staged = spark.table(version)
    try:
        if contract is not None:
            plain = T.StructType([T.StructField(f.name, f.dataType) for f in contract.fields])
            assert_schema(staged, plain, target)
        if nulls is not None:
            bad = {c: n for c, n in nulls.get.items() if n}
            if bad:
                raise DataQualityError(f"{target}: NULL in NOT NULL columns {bad}")
        if unique_keys:
            assert_no_rows(duplicate_keys(staged, unique_keys), f"{target} unique key {tuple(unique_keys)}")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    if spark.catalog.tableExists(target) and not _is_view(spark, target):
        spark.sql(f"DROP TABLE {target}")  # a plain table from an older layout
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {version}")
    for old in _versions(spark, name, database)[:-keep_versions]:
        spark.sql(f"DROP TABLE IF EXISTS {_qualified(old, database)}")
    return spark.table(target)


def load_fact(spark: SparkSession, clean_df: DataFrame, database: str | None = None) -> DataFrame:
    """Replace ``user_actions`` (NOT NULL ids), clustered by (org_id, user_id)."""
    return publish(
        spark,
        clean_df,
        FACT_TABLE,
        database,
        contract=USER_ACTIONS,
        not_null=("org_id", "user_id"),
        sort_within=("org_id", "user_id", "timestamp"),
    )


def load_dimensions(
    spark: SparkSession, organizations: DataFrame, users: DataFrame, database: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """The users → organizations check, then organizations, then users.

    Neither table is published if a user's organisation is unknown. Missing
    ``created_at`` columns take the load time (the table default).
    """
    assert_no_rows(orphan_users(users, organizations), "users.org_id not in organizations")
    orgs = publish(
        spark, organizations_from(organizations), "organizations", database, contract=ORGANIZATIONS,
        not_null=("org_id", "org_name"), unique_keys=("org_id",),
    )
    usrs = publish(
        spark, users_from(users), "users", database, contract=USERS,
        not_null=("user_id", "user_name"), unique_keys=("user_id",),
    )
    return orgs, usrs


def build_marts(
    ledger: DataFrame,
    organizations: DataFrame,
    users: DataFrame,
    as_of=None,
    rolled_up: bool = False,
) -> dict[str, DataFrame]:
    """The five marts as lazy DataFrames over the fact or its stored daily rollup.

    With ``rolled_up=True`` (``ledger`` is the stored rollup) the daily mart is a
    projection of it and the executive mart reads it directly (no stage).
    """
    return {
        "customer_success_daily_activity": M.cs_daily_activity(ledger, rolled_up=rolled_up),
        "finance_org_credit_balance": M.finance_org_balance(ledger),
        "enhanced_customer_success_view": M.cs_user_mart(ledger, organizations, users, as_of),
        "enhanced_finance_view": M.finance_mart(ledger, organizations),
        "executive_summary_view": M.executive_summary(
            ledger, organizations, users, materialize=not rolled_up
        ),
    }


def publish_marts(
    spark: SparkSession,
    marts: Mapping[str, DataFrame],
    database: str | None = None,
    parallel: bool = True,
    strict_nulls: bool = True,
) -> dict[str, DataFrame]:
    """Publish marts with their contracts and keys; independent marts run as concurrent jobs.

    With ``strict_nulls`` a NULL in a column that served rows must have (P12)
    fails the mart; such NULLs are counted while it is written.

    Each publish writes its own version table and swaps only its own view, so
    the jobs share nothing but their inputs; concurrent jobs keep the cluster
    busy through each other's small tail stages.
    """

    def one(name: str) -> DataFrame:
        return publish(
            spark, marts[name], name, database,
            contract=MART_CONTRACTS[name], unique_keys=MART_KEYS.get(name, ()),
            not_null=MART_NOT_NULL.get(name, ()) if strict_nulls else (),
        )

    if not parallel or len(marts) < 2:
        return {name: one(name) for name in marts}
    with ThreadPoolExecutor(max_workers=len(marts), thread_name_prefix="publish") as pool:
        futures = {name: pool.submit(one, name) for name in marts}
        return {name: future.result() for name, future in futures.items()}


@dataclass
class RunResult:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    report: DataFrame | None = None
    #: Q7: rows in, dropped by each rule, unparsed values and rows out, counted during the run.
    cleaning: dict[str, int] = field(default_factory=dict)


def run(
    spark: SparkSession,
    csv_path: str | list[str],
    organizations: DataFrame,
    users: DataFrame,
    as_of=None,
    database: str | None = None,
    options: CleanOptions = CleanOptions(),
    parallel: bool = True,
    strict_nulls: bool = True,
) -> RunResult:
    """CSV → clean fact → daily rollup → five marts, each stage a stored table."""
    result = RunResult()
    orgs, usrs = load_dimensions(spark, organizations, users, database)
    result.tables["organizations"], result.tables["users"] = orgs, usrs
    raw = read_raw_actions(spark, csv_path)
    counts = Observation(f"cleaning_{uuid.uuid4().hex}")
    with stage_scope(spark):  # the cleaning stages are dropped once the fact is published
        fact = load_fact(spark, clean(raw, options, counts=counts), database)
    result.cleaning = observed_report(counts, fact.count(), raw, options)  # the count reads file footers only
    result.tables[FACT_TABLE] = fact
    rollup = publish(spark, M.daily_rollup(fact), ROLLUP_TABLE, database)
    result.tables[ROLLUP_TABLE] = rollup
    marts = build_marts(rollup, orgs, usrs, as_of, rolled_up=True)
    result.tables.update(publish_marts(spark, marts, database, parallel, strict_nulls))
    result.report = table_check({n: result.tables[n] for n in (FACT_TABLE, *MART_NAMES)})
    return result


def refresh_marts(
    spark: SparkSession,
    names: Sequence[str] | None = None,
    as_of=None,
    database: str | None = None,
    parallel: bool = True,
    strict_nulls: bool = True,
) -> dict[str, DataFrame]:
    """Recompute marts from the currently published fact and dimensions.

    Like a materialized-view refresh: nothing is re-ingested; the daily rollup
    is rebuilt from ``user_actions``, then each chosen mart (default: all five)
    is published again. Readers keep the previous version until each swap.
    """
    names = list(names or MART_NAMES)
    unknown = set(names) - set(MART_NAMES)
    if unknown:
        raise ValueError(f"unknown marts: {sorted(unknown)}")
    fact = spark.table(_qualified(FACT_TABLE, database))
    orgs = spark.table(_qualified("organizations", database))
    usrs = spark.table(_qualified("users", database))
    rollup = publish(spark, M.daily_rollup(fact), ROLLUP_TABLE, database)
    marts = build_marts(rollup, orgs, usrs, as_of, rolled_up=True)
    return publish_marts(spark, {name: marts[name] for name in names}, database, parallel, strict_nulls)

