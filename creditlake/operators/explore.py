"""Exploration helpers: distinct identifiers and optional de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEDUP_KEYS = ("org_id", "user_id", "credit_type", "timestamp")


def distinct_ids(df: DataFrame, columns: Sequence[str] = ("org_id", "user_id")) -> DataFrame:
    """Every distinct value of each id column, as (id_column, id_value); one scan for all columns."""
    ids = F.array(*[F.struct(F.lit(c).alias("id_column"), F.col(c).cast("string").alias("id_value")) for c in columns])
    return df.select(F.explode(ids).alias("id")).select("id.*").distinct()


def distinct_id_counts(df: DataFrame, columns: Sequence[str] = ("org_id", "user_id")) -> DataFrame:
    """Number of distinct values per id column (NULL counts as a value, as in unique())."""
    return distinct_ids(df, columns).groupBy("id_column").agg(F.count(F.lit(1)).alias("n_distinct"))


def dedup_actions(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS, order: str = "seq") -> DataFrame:
    """A21 (off by default in the pipeline): keep the first row (lowest ``order``) per key.

    An aggregate (``min_by`` over the whole row) rather than a window, so a hot
    key is combined map-side instead of being collected into one task.
    """
    others = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*others), F.col(order))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)
