"""A left join to one row a key that a hot key cannot hold up.

The side knows how many rows of the big input each of its keys has. Keys above
``hot_rows`` get salts, one for each ``hot_rows`` rows: the side's row is
repeated over them and each big row takes one by a hash of itself, so no task
gets more of a key than about ``hot_rows`` rows. Which keys are hot is the only
thing broadcast: at most (rows / hot_rows) keys. Rows without a key match
nothing and are spread too.

Whether the join itself broadcasts the side or shuffles is Spark's choice by
its size; the result and the plan's parts are the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 1_000_000
HOT_CONF = "spark.creditlake.hotRows"
NULL_SALTS = 256


def skew_join(
    big: DataFrame, side: DataFrame, key: str, rows: str, hot_rows: int | None = None, strategy: str | None = None
) -> DataFrame:
    """``big`` left-joined to ``side`` (one row a ``key``; ``rows``: how many rows ``big`` has of it).

    ``side`` should be stored: it is read twice. ``strategy`` is a join hint
    for it, e.g. "shuffle_hash"; None leaves the choice to Spark.
    """
    if hot_rows is None:
        hot_rows = int(big.sparkSession.conf.get(HOT_CONF, str(DEFAULT_HOT_ROWS)))
    salts = F.ceil(F.col(rows) / hot_rows).cast("int")
    hot = side.where(F.col(rows) > hot_rows).select(F.col(key).alias("_hot_key"), salts.alias("_salts"))
    own = F.xxhash64(*[F.col(f"`{c}`") for c in big.columns])
    salted = (
        big.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
        .withColumn(
            "_salt",
            F.when(F.col(key).isNull(), F.pmod(own, F.lit(NULL_SALTS)))
            .when(F.col("_salts").isNotNull(), F.pmod(own, F.col("_salts")))
            .otherwise(F.lit(0))
            .cast("int"),
        )
        .drop("_hot_key", "_salts")
    )
    spread = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1))).drop(rows)
    if strategy:
        spread = spread.hint(strategy)
    return salted.join(spread, [key, "_salt"], "left").drop("_salt")
