"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending array of the K smallest distinct 64-bit hashes of a
document's 5-word shingles (all of them, if there are fewer). Sketches of parts
merge into the sketch of the whole, and estimate the resemblance and the
containment of two documents and the number of distinct shingles.

A text of fewer than five words has its whole word sequence as one shingle; a
text without words, or null, has the empty sketch. Two empty sketches resemble
each other fully, an empty and another one not at all. Repeated rows get equal
fingerprints, and equal hashes count once; a very long text is one row, all of
whose shingles are hashed; empty tables give empty results; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import bucket_of, parts_for, text_bytes, whole, words

K = 128
WORDS = 5
PART_BYTES = 16 << 20
NO_ID = -(1 << 63)  # a null id comes first


def shingle_hashes(hashes: Column, count: Column) -> Column:
    """Hashes of the windows of WORDS over an array of word hashes."""
    windows = F.transform(
        F.sequence(F.lit(0), count - F.lit(WORDS)),
        lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(WORDS)]),
    )
    return (
        F.when(count >= WORDS, windows)
        .when(count > 0, F.array(F.xxhash64(hashes)))
        .otherwise(F.array().cast("array<bigint>"))
    )


def with_sketch(df: DataFrame, text: Column, name: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of ``text`` as ``name``; each step is its own column, so none is computed twice."""
    return (
        df.withColumn("__words", F.transform(words(text), lambda w: F.xxhash64(w)))
        .withColumn("__hashes", shingle_hashes(F.col("__words"), F.size("__words")))
        .withColumn(name, lowest(F.col("__hashes"), k))
        .drop("__words", "__hashes")
    )


def lowest(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return lowest(F.concat(a, b), k)


def merge_groups(sketches: DataFrame, key: str, sketch: str = "sketch", k: int = K) -> DataFrame:
    """One sketch a key: only hashes among a key's K lowest so far leave each task."""
    folded = F.aggregate(
        F.collect_list(sketch), F.array().cast("array<bigint>"), lambda acc, s: lowest(F.concat(acc, s), k)
    )
    salted = sketches.withColumn("__salt", F.pmod(F.xxhash64(sketch), F.lit(64)))
    parts = salted.groupBy(key, "__salt").agg(folded.alias(sketch))
    return parts.groupBy(key).agg(folded.alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of both."""
    union = merged(a, b, k)
    common = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(common / F.size(union))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(sketch, -1).cast("double") + float(1 << 63)) / float(1 << 64)
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that are in b as well."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) with the text of the next row in the order of (doc_id, text); the first follows the last.

    Ids are cut at quantiles into buckets of about PART_BYTES of text. The
    bounds are ids that occur, so each bucket starts with a known document,
    which is also put at the end of the bucket before it. One shuffle of the
    texts, and no task gets more than a bucket.
    """
    spark = docs.sparkSession
    own = docs.select("doc_id", whole(F.col("text")).alias("text"), F.coalesce("doc_id", F.lit(NO_ID)).alias("__at"))
    n = parts_for(spark, text_bytes(docs), PART_BYTES)
    cuts = F.percentile_approx("__at", F.array(*[F.lit(i / n) for i in range(1, n)]) if n > 1 else F.array(F.lit(0.5)), max(10_000, 8 * n))
    low, found = own.agg(F.min("__at"), cuts).first()
    bounds = sorted({low, *(found or [])} - {None}) or [0]
    bucket = bucket_of(F.col("__at"), bounds)
    starts = F.col("__at") == F.get(F.array(*[F.lit(b) for b in bounds]), F.col("__bucket"))
    before = F.when(F.col("__bucket") > 0, F.col("__bucket") - 1).otherwise(len(bounds) - 1)
    here = F.struct(F.col("__bucket").alias("bucket"), F.lit(0).alias("copy"))
    there = F.struct(before.cast("int").alias("bucket"), F.lit(1).alias("copy"))
    placed = (
        own.withColumn("__bucket", bucket)
        .withColumn("__place", F.explode(F.when(starts, F.array(here, there)).otherwise(F.array(here))))
        .select("doc_id", "text", "__at", "__place.bucket", "__place.copy")
        .repartition(len(bounds), "bucket")
    )
    order = Window.partitionBy("bucket").orderBy("copy", "__at", "text")
    return placed.withColumn("next_text", F.lead("text").over(order)).where("copy = 0").select("doc_id", "text", "next_text")
