"""Phrase collocation mining by top-order marginalisation.

Texts (A-Z lower-cased) are split at ``.,;:!?`` and line ends into pieces, and
these at blanks into words. Each word occurrence gives one window: itself and
the words that follow it in its piece, in LONGEST columns, padded with null.
Only these windows are counted, equal ones of a task before they leave it, and
a task reads TASK_BYTES of text, as every task gives most of the frequent
windows again; Spark's ROLLUP then sums the counts of ever shorter prefixes, and
the count of a prefix is that of the phrase, as every occurrence begins at one
place. The first level, by language alone, is the number of words. A task holds
up to MOST_HELD windows, as codes of their words; beyond half of that, it gives
them out and starts anew.

A window goes on only past pairs and triples of words that may be frequent: a
first pass adds up, by a hash of (language, word or pair), at most LEAST per
stretch of text, and a hash whose sum stays below LEAST holds nothing frequent;
a second pass does the same for the triples of such pairs. A phrase with LEAST
occurrences has nothing rare in it, so its count stays exact; other long
windows fall to short ones, and rare words count for their language only. A
pass's outcome is one bit a hash, broadcast: the number of hashes follows the
size of the texts up to 2**MOST_BITS (16 MB).
Windows of three words and more go through a ROLLUP of their own, whose sums
over one or two words join the short ones; so no short window is expanded to
the levels of the long ones.

A phrase's score is the least over its cuts in two of floor(1000 a n / (l r)),
in exact decimals. Phrases inside a longer frequent phrase that occurs in all
of their places are dropped, and each language's best are ranked.

Nulls: a null text is empty, a null language is ``und``; documents need no ids
and repeated rows count again. A very long text is one stretch. Ties in score
go by count, then by the phrase's bytes. Empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import kept, shipped, spread_lookup, text_bytes
from creditlake.llm.grams import LOWER, Texts, U, batches, joined, word_units
from creditlake.llm.repeats import as_table, cut_by
from creditlake.plans.materialize import materialize

LEAST = 100
LONGEST = 5
TOP = 2000
ABSORB_PERCENT = 100
NO_LANG = "und"
STRETCH_BYTES = 4 << 20
HELD_STRETCH_BYTES = 1 << 20
TASK_BYTES = 128 << 20
MOST_HELD = 1 << 20
GIVEN_ROWS = 1 << 16
LEAST_BITS, MOST_BITS = 16, 27
INNER_BITS = 16
HOT = 1_000
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
GAP = BREAK.copy()
GAP[[0x20, 0x09]] = True
HASHES = "bucket int, low binary, count binary"


class Stretch(NamedTuple):
    """Words of some texts: a code each, what the codes stand for, their languages, and whether the next word follows in the same piece."""

    code: np.ndarray
    words: pa.Array
    lang: np.ndarray
    langs: pa.Array
    linked: np.ndarray


def stretches(batch: pa.RecordBatch, most: int = STRETCH_BYTES) -> Iterator[Stretch]:
    """The words of a batch of (text, lang), in stretches of about ``most`` bytes."""
    texts = Texts.of(batch.column("text"))
    for at, to in batches(np.diff(texts.begins), most):
        begins = texts.begins[at : to + 1] - texts.begins[at]
        data = texts.data[texts.begins[at] : texts.begins[to]]
        gap = GAP[data]
        first = np.zeros(len(data) + 1, bool)
        first[begins] = True
        open_ = ~gap
        starts = np.flatnonzero(open_ & (np.append(True, gap[:-1]) | first[:-1])) if len(data) else np.zeros(0, np.int64)
        if not len(starts):
            continue
        ends = np.flatnonzero(open_ & (np.append(gap[1:], True) | first[1:])) + 1
        owner = np.searchsorted(begins, starts, "right") - 1
        breaks = np.append(0, np.cumsum(BREAK[data]))
        linked = np.append((owner[1:] == owner[:-1]) & (breaks[starts[1:]] == breaks[ends[:-1]]), False)
        offsets = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
        letters = LOWER[data[open_]]
        words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        lang = batch.column("lang").slice(at, to - at).dictionary_encode()
        yield Stretch(words.indices.to_numpy(), words.dictionary, lang.indices.to_numpy()[owner], lang.dictionary, linked)


def word_hashes(own: Stretch) -> np.ndarray:
    """A hash of (language, word) for each word."""
    hashes = word_units(Texts.of(own.words)).hashes
    lang = np.array([zlib.crc32(x.encode()) for x in own.langs.to_pylist()], U)
    return joined(lang[own.lang], hashes[own.code])


class Frequent(NamedTuple):
    """Which words, pairs and triples may be frequent: a bit for each of 2**bits hashes of either kind."""

    bits: int
    pairs: bytes
    triples: bytes | None = None

    def often(self, table: bytes, hashes: np.ndarray) -> np.ndarray:
        known = np.frombuffer(table, np.uint8)
        key = hashes >> U(64 - self.bits)
        return (known[key >> U(3)] >> (U(7) - (key & U(7))).astype(np.uint8)) & 1 > 0

    def marked(self, own: Stretch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each word: may it be frequent, with the next, with the next two; and the hashes of (word, next, next but one) where pairs are."""
        single = word_hashes(own)
        n = len(single)
        word, pair, triple = self.often(self.pairs, single), np.zeros(n + 1, bool), np.zeros(n + 1, bool)
        at = np.flatnonzero(own.linked)
        at = at[word[at] & word[at + 1]]
        pair[at] = self.often(self.pairs, joined(single[at], single[at + 1]))
        at = np.flatnonzero(pair[:-1] & pair[1:])
        hashes = joined(joined(single[at], single[at + 1]), single[at + 2])
        if self.triples is not None:
            triple[at] = self.often(self.triples, hashes)
        return word, pair[:n], triple[:n], hashes


def frequent_hashes(docs: DataFrame, bits: int, least: int, hashes_of: Callable[[Stretch], np.ndarray]) -> bytes:
    """One bit for each of 2**bits hashes: may what has this hash be frequent?"""

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for own in stretches(row):
                value, count = np.unique(hashes_of(own) >> U(64 - bits), return_counts=True)
                count = np.minimum(count, least).astype(np.uint16)
                low = (value & U((1 << INNER_BITS) - 1)).astype(np.uint16)
                found = [
                    {"bucket": b, "low": np.diff(low[m], prepend=np.uint16(0)).tobytes(), "count": count[m].tobytes()}
                    for b, m in cut_by((value >> U(INNER_BITS)).astype(np.int64))
                ]
                yield from as_table(found, HASHES).to_batches()

    def judged(table: pa.Table) -> pa.Table:
        total = np.zeros(1 << INNER_BITS, np.int64)
        for low, count in zip(table.column("low").to_pylist(), table.column("count").to_pylist(), strict=True):
            at = np.cumsum(np.frombuffer(low, np.uint16), dtype=np.int64)
            total[at] += np.frombuffer(count, np.uint16)  # a stretch has a hash once
        packed = np.packbits(total >= least).tobytes()
        return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "bits": pa.array([packed], pa.binary())})

    ranges = docs.mapInArrow(counted, HASHES).groupBy("bucket").applyInArrow(judged, "bucket int, bits binary").collect()
    size = (1 << INNER_BITS) // 8
    out = bytearray(size << (bits - INNER_BITS))
    for r in ranges:
        out[r["bucket"] * size : (r["bucket"] + 1) * size] = r["bits"]
    return bytes(out)


def frequent(docs: DataFrame, bits: int, least: int = LEAST) -> Broadcast[Frequent]:
    """What may be frequent, broadcast, by a pass over words and pairs and one over triples."""

    def words_and_pairs(own: Stretch) -> np.ndarray:
        single = word_hashes(own)
        at = np.flatnonzero(own.linked)
        return np.concatenate([single, joined(single[at], single[at + 1])])

    context = docs.sparkSession.sparkContext
    first = context.broadcast(Frequent(bits, frequent_hashes(docs, bits, least, words_and_pairs)))
    triples = frequent_hashes(docs, bits, least, lambda own: first.value.marked(own)[3])
    both = context.broadcast(Frequent(bits, first.value.pairs, triples))
    first.unpersist()
    return both


def window_columns(longest: int) -> list[str]:
    return [f"w{i}" for i in range(1, longest + 1)]


def coded(known: pa.Array, values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``known`` and those of the distinct ``values`` that it lacks, and the place of each value in both."""
    place = pc.index_in(values, known)
    missing = place.is_null()
    place = place.fill_null(-1).to_numpy().copy()
    place[place < 0] = np.arange(len(known), len(known) + (place < 0).sum())
    return pa.concat_arrays([known, values.filter(missing)]), place


class Held:
    """Windows of one task as codes of their language and words (-1: padding), and how often each occurs."""

    def __init__(self, longest: int, most: int) -> None:
        self.names, self.most = ["lang", *window_columns(longest)], most
        self.clear()

    def clear(self) -> None:
        self.langs = self.words = pa.array([], pa.string())
        self.tables: list[pa.Table] = []

    def summed(self, table: pa.Table) -> pa.Table:
        return table.group_by(self.names, use_threads=False).aggregate([("n", "sum")]).select([*self.names, "n_sum"]).rename_columns([*self.names, "n"])

    def add(self, own: Stretch, word: np.ndarray, pair: np.ndarray, triple: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Take in the windows of a stretch; gives out all where too many stay distinct."""
        n, longest = len(word), len(self.names) - 1
        self.langs, lang = coded(self.langs, own.langs)
        used = np.zeros(len(own.words), bool)
        used[own.code[word]] = True
        place = np.full(len(own.words), -1, np.int32)
        self.words, place[used] = coded(self.words, own.words.filter(pa.array(used)))
        code = np.append(np.where(word, place[own.code], -1), np.full(longest, -1)).astype(np.int32)
        triple = np.append(triple, np.zeros(longest, bool))
        columns, goes_on = [lang[own.lang].astype(np.int32), code[:n]], pair
        for k in range(1, longest):
            goes_on = goes_on & triple[k - 2 : n + k - 2] if k > 1 else pair
            columns.append(np.where(goes_on, code[k : n + k], np.int32(-1)))
        self.tables.append(self.summed(pa.table([*columns, np.ones(n, np.int64)], [*self.names, "n"])))
        if sum(len(t) for t in self.tables) > self.most:
            self.tables = [self.summed(pa.concat_tables(self.tables))]
            if len(self.tables[0]) > self.most // 2:
                yield from self.given()

    def given(self) -> Iterator[pa.RecordBatch]:
        """The windows with their words, and nothing held any more."""
        if self.tables:
            whole = self.summed(pa.concat_tables(self.tables)) if len(self.tables) > 1 else self.tables[0]
            for part in whole.to_batches(max_chunksize=GIVEN_ROWS):
                columns = [self.langs.take(part.column("lang"))]
                for name in self.names[1:]:
                    at = part.column(name)
                    columns.append(self.words.take(pc.if_else(pc.less(at, 0), pa.scalar(None, at.type), at)))
                yield pa.RecordBatch.from_arrays([*columns, part.column("n")], [*self.names, "n"])
        self.clear()


def windows(docs: DataFrame, known: Broadcast[Frequent], longest: int = LONGEST, most: int = MOST_HELD) -> DataFrame:
    """(lang, w1 .. , n): padded windows and how often they occur in a task's texts.

    One for each word occurrence; those of rare words are all padding.
    """

    def counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(longest, most)
        for row in rows:
            for own in stretches(row, HELD_STRETCH_BYTES):  # small, beside what is held
                yield from held.add(own, *known.value.marked(own)[:3])
        yield from held.given()

    ddl = ", ".join(f"{c} string" for c in ["lang", *window_columns(longest)]) + ", n long"
    return docs.mapInArrow(counted, ddl)


def rolled_up(counted: DataFrame, columns: list[str]) -> DataFrame:
    """(lang, words, f) of all prefixes of the windows that have no padding."""
    summed = counted.rollup("lang", *columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    phrase, real = F.array().cast("array<string>"), F.lit(False)
    for k in range(len(columns) + 1):
        here = F.col("level") == (1 << (len(columns) - k)) - 1
        phrase = F.when(here, F.array(*columns[:k]).cast("array<string>")).otherwise(phrase)
        real = real | (here & (F.col(columns[k - 1]).isNotNull() if k else F.lit(True)))
    return summed.where(real).select("lang", phrase.alias("words"), "f")


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, bits: int | None = None
) -> DataFrame:
    """(lang, words, f): each language's words (an empty list) and all phrases of up to ``longest`` words that occur ``least`` times, kept.

    Of single words only those are sure to be there that a longer phrase has.
    """
    shipped(docs.sparkSession)
    own = docs.select(F.col(text).cast("string").alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"))
    total = text_bytes(own)
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, (total >> 6).bit_length()))
    columns = window_columns(max(longest, 2))
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    # Stored once, as Parquet: both rollups read it.
    made = materialize(windows(own.coalesce(tasks), frequent(own, bits, least), len(columns)), "windows")
    ending = F.col(columns[2]).isNull() if longest > 2 else F.lit(True)
    short = made.where(ending).select("lang", "w1", "w2", "n")
    long = made.where(~ending).groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    long = kept(rolled_up(long, columns).where((F.size("words") == 2) | ((F.size("words") > 2) & (F.col("f") >= least))))
    pairs = long.where(F.size("words") == 2).select("lang", F.col("words")[0].alias("w1"), F.col("words")[1].alias("w2"), F.col("f").alias("n"))
    sums = rolled_up(short.unionByName(pairs), ["w1", "w2"]).where((F.size("words") == 0) | (F.col("f") >= least))
    return kept(sums.unionByName(long.where(F.size("words") > 2)))


def named(words: Column) -> Column:
    """One text for a language and its phrase; phrases have no line ends, so no two share it."""
    return F.concat("lang", F.lit("\n"), F.array_join(words, " "))


def looked_up(rows: DataFrame, key: str, counts: DataFrame, value: str) -> DataFrame:
    """``rows`` with ``value`` of the row of ``counts`` (key, value) with their key; keys of many rows meet theirs in many tasks."""
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > HOT)
    hot = kept(hot.join(counts, key).select(key, value))
    tried = spread_lookup(rows, hot, key, F.xxhash64(*rows.columns))
    rest = tried.where(F.col(value).isNull()).drop(value).join(counts, key)
    return tried.where(F.col(value).isNotNull()).unionByName(rest)


def scored(counts: DataFrame, absorb_percent: int = ABSORB_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words and more in ``counts`` that no longer one takes up."""
    known = counts.where(F.size("words") > 0).select(named(F.col("words")).alias("key"), "f")
    total = kept(counts.where(F.size("words") == 0).select("lang", F.col("f").alias("n")))
    phrases = counts.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"), named(F.col("words")).alias("key"))
    size = F.size("words")
    within = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda k: F.transform(F.sequence(F.lit(1), F.size("words") - k + 1), lambda i: F.slice("words", i, k)),
        )
    )
    inner = phrases.where(size > 2).select("lang", F.explode(within).alias("inner"), "a")
    longer = inner.groupBy(named(F.col("inner")).alias("key")).agg(F.max("a").alias("longer"))
    left_over = phrases.join(longer, "key", "left").where(F.coalesce(100 * F.col("longer") < absorb_percent * F.col("a"), F.lit(True)))
    cuts = left_over.drop("longer").withColumn("cut", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = kept(
        cuts.select(
            "lang", F.array_join("words", " ").alias("phrase"), "a", "cut",
            named(F.slice("words", F.lit(1), F.col("cut"))).alias("first"),
            named(F.slice("words", F.col("cut") + 1, size - F.col("cut"))).alias("second"),
        )
    )
    met = looked_up(cuts, "first", known.select(F.col("key").alias("first"), F.col("f").alias("l")), "l")
    met = looked_up(met, "second", known.select(F.col("key").alias("second"), F.col("f").alias("r")), "r")
    met = spread_lookup(met, total, "lang", F.xxhash64("phrase", "cut"))
    wide = {c: f"CAST({c} AS DECIMAL(19,0))" for c in "anlr"}
    score = F.expr(f"(CAST(1000 AS DECIMAL(4,0)) * {wide['a']} * {wide['n']}) div ({wide['l']} * {wide['r']})")
    best = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best")
    return met.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP, **settings) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    found = scored(phrase_counts(docs, text, lang, **settings))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = found.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
