"""Stored tables: parquet by path, or a catalog table by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()

# Declared schemas of the driver's tables: reading with a schema skips the
# footer-sampling inference pass at planning time.
DRIVER_SCHEMAS = {
    "region": [("r_regionkey", _I), ("r_name", _S)],
    "nation": [("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)],
    "customer": [
        ("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I), ("c_acctbal", _D), ("c_mktsegment", _S),
    ],
    "orders": [
        ("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S), ("o_totalprice", _D),
        ("o_orderdate", _TS), ("o_orderpriority", _S),
    ],
    "events": [
        ("event_id", _L), ("ts", _TS), ("user_id", _L), ("event_type", _S), ("value", _D), ("props", _S),
    ],
}


def read_parquet_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``{root}/{name}.parquet`` (the driver's layout), with its declared schema when known."""
    reader = spark.read
    fields = DRIVER_SCHEMAS.get(name)
    if fields:
        reader = reader.schema(T.StructType([T.StructField(n, t, True) for n, t in fields]))
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full scan of a published table or mart (column pruning is left to Catalyst)."""
    return spark.table(name)
