"""Connected components of an edge table by alternating large and small stars, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import kept, packed


def components(edges: DataFrame, most: int) -> DataFrame:
    """(node, label) for every node of the edges (a, b): the label is the least node of its component.

    Each round points every node at the least of its neighbours; a node with
    very many edges is only ever met by a combinable minimum and a join. About
    log(n) rounds, each checkpointed. There are ``most`` edges at most, and no
    round makes more; the number of its tasks follows from that.
    """
    now = kept(packed(packed(edges, most).where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), most))
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select("v", "v").distinct())
        before, rows = state, 2 * state[0]
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = kept(packed(packed(large, rows).distinct(), rows))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept(packed(packed(small.union(least.select("u", "m")), rows).distinct(), rows))
