"""Write an intermediate result once to the shared checkpoint folder and read it back.

Used where one derived result feeds several consumers or a size check. Compared
with ``DataFrame.checkpoint()`` (serialized rows), a Parquet stage is columnar
and compressed, and each consumer reads only the columns it needs. The stored
files cut lineage: a lost executor re-reads them instead of recomputing
upstream.

Inside a ``stage_scope`` (where the caller knows when the stage is no longer
needed) a stage is a managed table of a stage database located in the shared
folder, and it is dropped through the catalog when the scope ends. Outside a
scope (a lazy result handed to a caller) it is a plain Parquet folder there.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from creditlake.session import checkpoint_dir

STAGE_DATABASE = "creditlake_stages"

_SCOPE: ContextVar[list[str] | None] = ContextVar("creditlake_stage_scope", default=None)


def _stage_database(spark: SparkSession) -> str:
    location = f"{checkpoint_dir(spark).rstrip('/')}/{STAGE_DATABASE}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGE_DATABASE} LOCATION '{location}'")
    return STAGE_DATABASE


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and return a DataFrame over the stored rows."""
    spark = df.sparkSession
    scope = _SCOPE.get()
    if scope is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/creditlake-{label}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    else:
        name = f"{_stage_database(spark)}.{label.replace('-', '_')}_{uuid.uuid4().hex}"
        df.write.mode("errorifexists").format("parquet").saveAsTable(name)
        scope.append(name)
        return spark.table(name)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Drop every stage materialized inside the block when it ends."""
    names: list[str] = []
    token = _SCOPE.set(names)
    try:
        yield names
    finally:
        _SCOPE.reset(token)
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
