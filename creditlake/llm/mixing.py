"""Mixing sources to target weights: tokens per source, repetition rates, seeded copies.

Each source's share of the mix follows its weight; no source is repeated more
than ``most`` times, and what it can't take is shared out again by weight among
the rest. A document is then taken floor(rate) times, plus once more with a
probability equal to the fraction, drawn from a hash of the seed and its id.

Nulls: a null source is a source of its own, last in order; a null text has
size 0; a null id draws as the text "null". Repeated rows with one id draw
alike. A source without words has target 0 and rate 0. An empty table gives an
empty result. A very long text counts as any other: a document goes whole or
not at all. Ties need no order: sources are told apart by name. Other columns
pass through, but for the names __mix and __source, which are taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import kept, spread_lookup, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ranked(keys: DataFrame, key: str) -> DataFrame:
    """Position of each row in the order of ``key``, nulls last, without gathering the rows in one task.

    Rows are sorted over range partitions; only the partitions' row counts are
    summed up together.
    """
    ordered = kept(keys.orderBy(F.col(key).asc_nulls_last()))
    at = F.monotonically_increasing_id()
    ordered = ordered.select("*", F.shiftright(at, 33).alias("__part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("__row"))
    before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    return ordered.join(offsets, "__part").withColumn("rank", F.col("__before") + F.col("__row")).drop("__part", "__row", "__before")


def source_targets(
    sizes: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """One row a source: its size, weight and target. Weights repeat over the sources in code point order."""
    totals = sizes.groupBy(F.col(source).alias("source")).agg(F.sum(size).cast("long").alias("source_size"))
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank"), F.lit(len(weights))).cast("int"))
    sources = kept(
        ranked(totals, "source")
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * float(most))
        .drop("rank")
    )
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, -1
    while True:  # each round closes at least one more source, or is the last
        closed = F.lit(False) if level is None else F.col("most") <= F.col("weight") * level
        taken, open_weight, count = sources.agg(
            F.sum(F.when(closed, F.col("most"))), F.sum(F.when(~closed, F.col("weight"))), F.count(F.when(closed, 1))
        ).first()
        if count == full or not open_weight:
            break
        full = count
        level = (share * total - (taken or 0.0)) / open_weight
    target = F.col("most") if level is None else F.least("most", F.col("weight") * level)
    if level is not None and not open_weight:
        target = F.col("most")
    return sources.select("source", "source_size", "weight", target.alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the seed and the id, the same in every run."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def copies(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", source: str = "source", seed: str = SEED) -> DataFrame:
    """``docs`` with a struct ``__mix``: source_size, target and the number of copies to take of the row."""
    small = targets.select(F.col("source").alias("__source"), F.struct("source_size", "target").alias("__of_source"))
    known = spread_lookup(docs.withColumn("__source", F.col(source)), small, "__source", F.col(doc_id))
    size, target = F.col("__of_source.source_size"), F.col("__of_source.target")
    rate = F.when(size > 0, target / size).otherwise(0.0)
    more = (draw(F.col(doc_id), seed) < rate - F.floor(rate)).cast("long")
    made = F.struct(size.alias("source_size"), target.alias("target"), (F.floor(rate) + more).alias("copies"))
    return known.withColumn("__mix", made).drop("__source", "__of_source")


def mix(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", seed: str = SEED, **settings
) -> DataFrame:
    """``docs`` as mixed: every row repeated as often as it is taken."""
    sizes = docs.select(F.col(source).alias("source"), size_of(F.col(text)).alias("size"))
    taken = copies(docs, source_targets(sizes, **settings), doc_id, source, seed).where("__mix.copies > 0")
    repeated = taken.withColumn("__copy", F.explode(F.expr("sequence(1L, __mix.copies)")))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
