"""Small helpers that the operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[\x20\x09-\x0D]+"
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    return F.array_remove(F.split(whole(text), SPACES), "")


def ready(spark: SparkSession) -> SparkSession:
    """Make checkpoint() usable: the cluster's spark.checkpoint.dir, or a scratch folder on a local master."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if context.master != "local" and not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            shared = tempfile.mkdtemp(prefix="llm-checkpoints-")
        context.setCheckpointDir(shared)
    return spark


def shipped(spark: SparkSession) -> SparkSession:
    """Send this package's source to the Python workers, once a context, as the cluster may not have it installed."""
    context = spark.sparkContext
    if not getattr(context, "_creditlake_shipped", False):
        root = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="llm-source-")) / f"{root.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(root.rglob("*.py")):
                out.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
        context._creditlake_shipped = True
    return spark


def kept(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder, so that a lost executor costs a re-read only."""
    ready(df.sparkSession)
    return df.checkpoint()


def packed(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """Run the last stage of ``df``, of at most ``rows`` rows, in no more tasks than ``each`` rows a task ask for.

    Rounds over small tables would otherwise run and write one tiny file a shuffle
    partition; a large table keeps all its partitions.
    """
    return df.coalesce(max(1, -(-int(rows) // each)))


def parts_for(spark: SparkSession, total_bytes: int, each: int) -> int:
    """Number of parts of about ``each`` bytes, at least the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // each))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(whole(F.col(text))))).first()[0] or 0


def bucket_of(value: Column, bounds: Sequence[int]) -> Column:
    """Index of the last of the ascending ``bounds`` that is <= value (0 below the first), by binary search."""
    if len(bounds) < 2:
        return F.lit(0)
    table_ = F.array(*[F.lit(int(b)) for b in bounds]) if len(bounds) < 64 else F.from_json(
        F.lit(str([int(b) for b in bounds])), "array<bigint>"
    )
    step = 1 << (len(bounds).bit_length() - 1)
    steps = []
    while step:
        steps.append(F.lit(step))
        step >>= 1

    def advance(at: Column, by: Column) -> Column:
        fits = (at + by < len(bounds)) & (F.get(table_, at + by) <= value)
        return F.when(fits, at + by).otherwise(at)

    return F.aggregate(F.array(*steps), F.lit(0), advance)


def spread_lookup(big: DataFrame, small: DataFrame, key: str, row_key: Column, salts: int = 32) -> DataFrame:
    """Left join of ``big`` to one row a key of ``small`` (null matches null).

    ``small`` is broadcast only after its bytes are counted; a larger one is
    replicated over ``salts``, so that a key holding a third of ``big`` meets
    it in many tasks. ``small`` should be checkpointed: it is read twice.
    """
    width = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(1)) + 16 for c in small.columns), F.lit(0))
    measured = small.agg(F.sum(width)).first()[0] or 0
    right = small.withColumnRenamed(key, "__key")
    if measured <= BROADCAST_BYTES:
        return big.join(F.broadcast(right), F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    left = big.withColumn("__salt", F.pmod(F.xxhash64(row_key), F.lit(salts)).cast("int"))
    right = right.withColumn("__of", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = F.col(key).eqNullSafe(F.col("__key")) & (F.col("__salt") == F.col("__of"))
    return left.join(right, on, "left").drop("__key", "__salt", "__of")
