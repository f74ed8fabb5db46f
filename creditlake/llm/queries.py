"""The registered queries of this package."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.llm import bpe, bwt_dedup, chat, collocations, fingerprints, mixing, near_dedup, prefix_trie, quality, seed_extend, token_counts, token_files, warc
from creditlake.llm.common import table


def archive_records(pages: DataFrame) -> DataFrame:
    """A response for each row of ``pages``, and a later revisit of its URL by another spelling.

    Times, validators and headers follow from the page: some revisits carry an
    old tag, only a date, or no validator at all, and some come before the
    first response.
    """
    p = F.col("page_id")
    digest = F.sha2(F.coalesce("html", F.lit("")), 256)
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    day = F.concat(F.lit("day "), (p % 97).cast("string"))
    response = F.struct(
        (2 * p).alias("record_id"),
        F.lit("response").alias("kind"),
        F.col("url"),
        (1000 * p).alias("ts"),
        F.create_map(
            F.lit("Content-Type"), F.lit("text/html"), F.lit("Date"), F.concat(F.lit("t"), (1000 * p).cast("string")),
            F.lit("ETag"), tag, F.lit("Last-Modified"), day, F.lit("Set-Cookie"), F.concat(F.lit("a="), p.cast("string")),
        ).alias("headers"),
        digest.alias("digest"),
    )
    late = F.when(p % 10 == 9, -500).otherwise((p % 5) * 1_000_000 + 500)
    fields = F.map_filter(
        F.create_map(
            F.lit("Date"), F.concat(F.lit("t"), (1000 * p + late).cast("string")),
            F.lit("Etag"), F.when(p % 3 == 0, F.concat(F.lit("W/"), tag)).when(p % 7 == 1, F.lit('"old"')).when(p % 3 == 1, tag),
            F.lit("Last-Modified"), F.when(p % 6 != 5, day),
            F.lit("Cache-Control"), F.when(p % 2 == 0, F.lit("max-age=60")),
            F.lit("Set-Cookie"), F.lit("b=1"),
        ),
        lambda k, v: v.isNotNull(),
    )
    bare = F.regexp_replace("url", r"#.*$", "")
    revisit = F.struct(
        (2 * p + 1).alias("record_id"),
        F.lit("revisit").alias("kind"),
        F.when(p % 4 == 0, F.concat(bare, F.lit("#part"))).when(p % 4 == 1, F.regexp_replace(bare, "^http:", "HTTPS:")).otherwise(F.col("url")).alias("url"),
        (1000 * p + late).alias("ts"),
        fields.alias("headers"),
        F.lit(None).cast("string").alias("digest"),
    )
    return pages.select(F.explode(F.array(response, revisit)).alias("r")).select("r.*")


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of the archive derived from ``pages``, with their merged headers as sorted lines."""
    out = warc.resolve(archive_records(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return out.withColumn("headers", F.array_join(lines, "\n"))


def op2_bwt_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that lie in a 50-byte string of an earlier one, removed."""
    cut = bwt_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.col(f"__{c}").alias(c) for c in ("n_bytes", "n_removed", "n_spans")]
    return cut.select("doc_id", *counts, F.sha2(F.col("__kept"), 256).alias("kept_sha256"))


def op3_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    docs = fingerprints.with_next(table(spark, sf_dir, "documents"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    made = fingerprints.with_sketch(docs.withColumn("edited", edited), F.col("text"), "own")
    made = fingerprints.with_sketch(made, F.col("edited"), "other")
    made = fingerprints.with_sketch(made, F.col("next_text"), "following")
    return made.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("own")).alias("fingerprint"),
        fingerprints.as_text(F.col("other")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("own"), F.col("other")).alias("near_edited"),
        fingerprints.resemblance(F.col("own"), F.col("following")).alias("near_next"),
        fingerprints.distinct_shingles(F.col("own")).alias("distinct_estimate"),
    )


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken from every document by the mix."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.size_of(F.col("text")).alias("size"))
    sizes = mixing.kept(docs)
    mixed = mixing.copies(sizes, mixing.source_targets(sizes))
    taken = (F.col("__mix.copies") * F.col("size")).alias("taken")
    return mixed.select("doc_id", "size", "__mix.source_size", "__mix.target", taken)


def op5_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates among all documents."""
    found = near_dedup.near_components(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every document; thresholds from the labels, by language."""
    scored = quality.scores(table(spark, sf_dir, "documents"))
    judged = quality.verdict(scored, quality.calibrate(scored, table(spark, sf_dir, "labels")))
    return judged.select(
        "doc_id",
        *[F.col(f"__f.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__failed").alias("base_failed"),
        F.col("__kept").alias("kept"),
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32k piece vocabulary."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


def op8_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 50-word passage of an earlier one, removed."""
    cut = seed_extend.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.col("__kept").cast("binary"), 256).alias("kept_sha256")
    return cut.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), digest)


def op9_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded by the 50k byte-level vocabulary."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    emitted = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return bpe.encode(table(spark, sf_dir, "documents"), vocabulary, emit=bpe.emit_digests, emitted=emitted)


def op10_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations formatted along their best branch, read back from the formatted text."""
    told = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(told).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    score = F.when(F.col("role") == "assistant", F.length("text")).cast("double")
    nodes = chat.kept(chat.linear(turns).withColumn("score", score))
    made = chat.format_paths(chat.branches(nodes))
    back = made.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op11_rollup_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of two to five words of each language of ``documents``."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all conversations, the first turns of some replaced by those of another."""
    c = F.col("conv_id")
    turns = table(spark, sf_dir, "conversations")
    return prefix_trie.nodes(prefix_trie.rebuilt(turns, (F.crc32(c.cast("string").cast("binary")) % 4).cast("int"), c - c % 20))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place, length and checksum, read back from its token files."""
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = token_files.write(table(spark, sf_dir, "documents"), path, token_files.new_folder(spark), keep=("lang", "source"))
    rows = token_files.with_start(token_files.checksums(spark, folder), token_files.shard_starts(spark, folder))
    return rows.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), F.col("crc32").alias("ids_crc32"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_revisits, op2_bwt_intervals, op3_bottom_k, op4_mix, op5_lsh_forest, op6_quality_rules, op7_token_counts,
        op8_seed_extend, op9_tree_bpe, op10_reply_trees, op11_rollup_phrases, op12_prefix_trie, op13_token_files,
    )
}
