"""Pages at any offset of a large sorted result: a rank directory over stored ranges.

``store_ranked`` sorts once by range partitioning (no single task sees all
rows), stores each range with its rows' positions, and keeps a directory of the
ranges' row counts. ``RankedTable.page`` finds the ranges that an offset needs
by that directory and opens only these: stored ranges are partition folders, so
the others are pruned before any file is read. ``RankedTable.after`` goes on
from a row by its key, which costs the same at any depth.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.session import checkpoint_dir

RANGE, PLACE, RANK = "_range", "_place", "_rank"
#: The row number within a partition is the low part of Spark's increasing id.
ROW_BITS = 33
BLOCK = 1024


@dataclass(frozen=True)
class RankedTable:
    spark: SparkSession
    folder: str
    schema: T.StructType

    def rows(self) -> DataFrame:
        """All stored rows with their range and their place in it."""
        stored = T.StructType([*self.schema.fields, T.StructField(PLACE, T.LongType()), T.StructField(RANGE, T.IntegerType())])
        return self.spark.read.schema(stored).parquet(f"{self.folder}/rows")

    def directory(self) -> DataFrame:
        """(range, rows, start): one row a range that has rows."""
        return self.spark.read.parquet(f"{self.folder}/directory")

    def total(self) -> int:
        return self.directory().agg(F.sum("rows")).first()[0] or 0

    def page(self, limit: int | None = None, offset: int = 0, with_rank: bool = False) -> DataFrame:
        """Rows ``offset`` .. ``offset + limit`` in order; without a limit all from ``offset`` on, sorted by ranges."""
        start, end = F.col("start"), F.col("start") + F.col("rows")
        needed = self.directory().where(end > offset)
        if limit is not None:
            needed = needed.where(start < offset + limit)
        first = F.min(F.struct(RANGE, "start")).alias("first")
        last = F.max(F.struct(RANGE, "start")).alias("last")
        edge = needed.agg(first, last).first()
        if edge["first"] is None:
            return self._shown(self.rows().where(F.lit(False)).withColumn(RANK, F.lit(0).cast("long")), with_rank)
        low, high = edge["first"], edge["last"]
        found = self.rows().where(F.col(RANGE) >= low[RANGE])
        found = found.where((F.col(RANGE) > low[RANGE]) | (F.col(PLACE) >= offset - low["start"]))
        if limit is not None:
            found = found.where(F.col(RANGE) <= high[RANGE])
            found = found.where((F.col(RANGE) < high[RANGE]) | (F.col(PLACE) < offset + limit - high["start"]))
        if with_rank:
            starts = self.directory().select(RANGE, "start")
            found = found.join(starts, RANGE).withColumn(RANK, F.col("start") + F.col(PLACE)).drop("start")
        ordered = found.orderBy(RANGE, PLACE)
        return self._shown(ordered.limit(limit) if limit is not None else ordered, with_rank)

    def after(self, limit: int, **key) -> DataFrame:
        """The ``limit`` rows behind the first row with these column values; its range and later ones are opened."""
        match = F.lit(True)
        for column, value in key.items():
            match = match & F.col(column).eqNullSafe(F.lit(value))
        found = self.rows().where(match).agg(F.min(F.struct(RANGE, PLACE)).alias("at")).first()["at"]
        if found is None:
            raise KeyError(f"no row with {key}")
        behind = self.rows().where(F.col(RANGE) >= found[RANGE])
        behind = behind.where((F.col(RANGE) > found[RANGE]) | (F.col(PLACE) > found[PLACE]))
        return self._shown(behind.orderBy(RANGE, PLACE).limit(limit), False)

    def _shown(self, df: DataFrame, with_rank: bool) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in self.schema.names], *([RANK] if with_rank else []))


def store_ranked(df: DataFrame, order: list[Column], ranges: int | None = None, folder: str | None = None) -> RankedTable:
    """Sort ``df`` once by ``order`` (which should end in a tie-break) and store it with its rank directory."""
    spark = df.sparkSession
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/creditlake-ranked-{uuid.uuid4().hex}"
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    number = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = dealt.withColumns(
        {RANGE: F.shiftright(number, ROW_BITS).cast("int"), PLACE: number.bitwiseAND(F.lit((1 << ROW_BITS) - 1).cast("long"))}
    )
    placed.write.partitionBy(RANGE).parquet(f"{folder}/rows")
    table = RankedTable(spark, folder, df.schema)
    counted = table.rows().groupBy(RANGE).agg((F.max(PLACE) + 1).alias("rows")).withColumn("_block", F.floor(F.col(RANGE) / BLOCK))
    # Running sums by blocks of ranges, so that no window sees more than a block of them.
    inside = Window.partitionBy("_block").orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.groupBy("_block").agg(F.sum("rows").alias("_sum")).select("_block", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_base"))
    start = F.coalesce(F.sum("rows").over(inside), F.lit(0))
    directory = counted.withColumn("_inside", start).join(blocks, "_block").select(RANGE, "rows", (F.col("_inside") + F.col("_base")).alias("start"))
    directory.write.parquet(f"{folder}/directory")
    return table
