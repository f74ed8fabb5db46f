"""Data-quality checks, each a DataFrame so it runs distributed.

Every check returns rows describing violations (an empty result means clean) or
a small report; ``assert_*`` helpers turn them into exceptions for publishing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.schemas import LOW_COUNT_BELOW, VERDICT_EMPTY, VERDICT_LOW, VERDICT_PASSED


class DataQualityError(RuntimeError):
    pass


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1: key combinations that occur more than once, with their count."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def table_check(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, total_records, verdict) for each table, in one job."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("total_records")).select(
            F.lit(name).alias("table_name"), "total_records"
        )
        for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, rows)
    n = F.col("total_records")
    verdict = (
        F.when(n == 0, F.lit(VERDICT_EMPTY))
        .when(n < LOW_COUNT_BELOW, F.lit(VERDICT_LOW))
        .otherwise(F.lit(VERDICT_PASSED))
    )
    return counts.withColumn("verdict", verdict)


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows for inspection."""
    return df.limit(n)


def null_violations(
    table_name: str, df: DataFrame, not_null: Sequence[str], primary_key: Sequence[str] = ()
) -> DataFrame:
    """Q3: (table_name, check_name, column_name, violations), one row per check, one pass.

    NOT NULL counts come from one aggregate; the primary-key check counts rows
    beyond the first per key (a second, grouped aggregate).
    """
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in not_null],
    )
    stack = ", ".join(f"'{c}', `{c}`" for c in not_null)
    out = counts.selectExpr(f"stack({len(not_null)}, {stack}) as (column_name, violations)").select(
        F.lit(table_name).alias("table_name"),
        F.lit("not_null").alias("check_name"),
        "column_name",
        F.col("violations").cast("long").alias("violations"),
    )
    if primary_key:
        dup = duplicate_keys(df.select(*primary_key), primary_key).agg(
            F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("long").alias("violations")
        )
        out = out.unionByName(
            dup.select(
                F.lit(table_name).alias("table_name"),
                F.lit("primary_key").alias("check_name"),
                F.lit(",".join(primary_key)).alias("column_name"),
                "violations",
            )
        )
    return out


def orphan_users(users: DataFrame, organizations: DataFrame) -> DataFrame:
    """Q4: users whose org_id is set but absent from organizations."""
    return users.where(F.col("org_id").isNotNull()).join(
        organizations.select("org_id"), "org_id", "left_anti"
    )


def schema_mismatches(df: DataFrame, contract: T.StructType) -> list[str]:
    """Q5: differences in column names, order and types against a contract."""
    problems = []
    actual = [(f.name, f.dataType) for f in df.schema.fields]
    expected = [(f.name, f.dataType) for f in contract.fields]
    if [n for n, _ in actual] != [n for n, _ in expected]:
        problems.append(f"columns {[n for n, _ in actual]} != {[n for n, _ in expected]}")
    for (name, got), (_, want) in zip(actual, expected):
        if got != want:
            problems.append(f"{name}: {got.simpleString()} != {want.simpleString()}")
    return problems


def assert_no_rows(df: DataFrame, what: str) -> None:
    bad = df.limit(5).collect()
    if bad:
        raise DataQualityError(f"{what}: {len(bad)}+ violating rows, e.g. {bad[:3]}")


def assert_schema(df: DataFrame, contract: T.StructType, what: str) -> None:
    problems = schema_mismatches(df, contract)
    if problems:
        raise DataQualityError(f"{what}: schema differs: {problems}")


def assert_clean(report: DataFrame, what: str) -> None:
    bad = report.where(F.col("violations") > 0).collect()
    if bad:
        raise DataQualityError(f"{what}: {[(r.check_name, r.column_name, r.violations) for r in bad]}")
