"""Token-ID files: Parquet with list columns, for selective reads of tokens and metadata.

``write`` encodes texts and stores one row a document, in the order of the ids:
``ids`` as a list column, dictionary-encoded (a page holds bit-packed indexes)
or, with ``ids_encoding="delta"``, as bit-packed deltas; the counts and places
are delta-encoded, as nearly equal neighbours. Row groups and pages have set
sizes and Parquet's page index, so a reader of some documents or of a span of
the stream opens only the pages that it needs, and a reader of the metadata no
page of the ids.

Documents are range-partitioned by (id, hash of the text, place in the input),
so that rows of one id may span shards; a task sorts its shard, encodes it row
by row and writes one file. ``at`` is a document's place in its shard; the
shards' places are sums over their totals, by blocks of shards.

Texts are encoded by the vocabulary's own library. White space never reaches
its tokens, and no token spans it, so each distinct word of a slice of texts
is encoded once, or known from slices before; words are cut further where
letters and ``.,;:!?`` meet, as the vocabulary's pre-tokeniser does.
``check_vocabulary`` rejects files for which this does not hold.

Nulls: a null text is empty and has the end id only; a null id comes first.
Rows of one id are ordered by their text's hash, repeated rows by their place,
and each has tokens of its own. A very long text is one row; its words are
encoded one by one. Empty tables give files without rows. Columns named in
``keep`` are stored under their own names; others are ignored.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditlake.llm.bpe import byte_alphabet
from creditlake.llm.common import kept, parts_for, ready, shipped, spread_lookup, text_bytes, whole
from creditlake.llm.grams import LOWER, Texts, batches, spans

END_ID = 1
SHARD_BYTES = 32 << 20
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 1 << 18
SLICE_BYTES = 4 << 20
CACHED_PIECES = 600_000
CACHED_CHARS = 64
BLOCK = 1024
META = ("shard", "at", "n_tokens")
SPACE, MARK, LETTER, HIGH = (np.zeros(256, bool) for _ in range(4))
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Where one of these marks and a letter of Latin-1 meet (two bytes beyond ASCII), every pre-tokeniser of this kind has a border.
MARK[[*b".,;:!?"]] = True
LETTER[[*range(65, 91), *range(97, 123)]] = True
HIGH[[x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)]] = True
LEAD = 0xC3
SMALL = re.compile("[a-zà-öø-ÿ]+")
#: The pre-tokeniser's pattern and the normaliser's steps for which words can be encoded alone (fixed values of that format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase"]


def check_vocabulary(path: str) -> dict:
    """The parsed file, if its words can be encoded one by one."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    same = split.get("type") == "Split" and split["pattern"].get("Regex") == PATTERN and split["behavior"] == "Removed" and split["invert"]
    spaced = any(re.search(r"[\s.,;:!?]", t["content"]) or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
    if steps != STEPS or not same or spaced:
        raise ValueError(f"{path}: not a vocabulary of words without white space")
    return spec


def pieces(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of the texts begin and end: words, cut where letters and marks meet."""
    data = texts.data
    solid = np.concatenate([[False], ~SPACE[data], [False]])
    first = np.zeros(len(data) + 1, bool)
    first[texts.begins] = True
    two = np.append((data[:-1] == LEAD) & HIGH[data[1:]], False) if len(data) else LETTER[data]
    begins = LETTER[data] | two  # a letter begins at this byte
    ends = LETTER[data] | np.append(False, two[:-1]) if len(data) else begins  # a letter ends with it
    mark = MARK[data]
    meets = np.zeros(len(data) + 1, bool)
    meets[1:-1] = (ends[:-1] & mark[1:]) | (mark[:-1] & begins[1:])
    border = first | meets
    starts = np.flatnonzero(solid[1:] & (~solid[:-1] | border))
    stops = np.flatnonzero(solid[:-1] & (~solid[1:] | border))
    return starts, stops


class Words:
    """Encodes texts piece by piece with the library; pieces are remembered as long as there is room."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.special = [t["content"].encode().lower() for t in check_vocabulary(path)["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.alphabet = {b: c for c, b in byte_alphabet().items()}
        self.known: dict[str, bytes] = {}

    def learn(self, pieces_: list[str]) -> list[bytes]:
        """The ids of new pieces. One of small letters only is one pre-token as it is, so the library's model takes it at once."""
        tokenize, letters, make = self.library.model.tokenize, SMALL.fullmatch, array
        code = "H" if self.kind.itemsize == 2 else "I"
        out: list[bytes | None] = [None] * len(pieces_)
        other = []
        for i, piece in enumerate(pieces_):
            if not letters(piece):
                other.append(i)
            elif piece.isascii():
                out[i] = make(code, [t.id for t in tokenize(piece)]).tobytes()
            else:
                out[i] = make(code, [t.id for t in tokenize(piece.encode().decode("latin-1").translate(self.alphabet))]).tobytes()
        for i, made in zip(other, self.library.encode_batch_fast([pieces_[i] for i in other], add_special_tokens=False), strict=True):
            out[i] = make(code, made.ids).tobytes()
        return out

    def ids_of(self, pieces_: list[str]) -> list[bytes]:
        found = list(map(self.known.get, pieces_))
        new = [i for i, x in enumerate(found) if x is None]
        if len(self.known) + len(new) > CACHED_PIECES:
            self.known.clear()
        for i, made in zip(new, self.learn([pieces_[i] for i in new]), strict=True):
            found[i] = made
            if len(pieces_[i]) <= CACHED_CHARS:
                self.known[pieces_[i]] = made
        return found

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        starts, stops = pieces(texts)
        letters = texts.data[~SPACE[texts.data]]
        if not any(s in letters.tobytes().lower() for s in self.special):
            letters = LOWER[letters]  # fewer distinct pieces; added tokens are not normalised
        offsets = np.append(0, np.cumsum(stops - starts)).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
        found = self.ids_of(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        flat = np.frombuffer(b"".join(found), self.kind)
        code = words.indices.to_numpy()
        heads = np.cumsum(sizes) - sizes
        ids = flat[spans(heads[code], sizes[code])].astype(np.int32)
        total = np.append(0, np.cumsum(sizes[code]))
        return ids, np.diff(total[np.searchsorted(starts, texts.begins)])


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Words:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Words(path)


def encoded(docs: DataFrame, path: str, doc_id: str, text: str, keep: Sequence[str], end_id: int, shard_bytes: int) -> DataFrame:
    """(doc_id, kept columns, shard, at, n_tokens, ids) in the order of the ids, a shard a partition."""
    shipped(docs.sparkSession)
    names = [f"k{i}" for i in range(len(keep))]
    own = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)],
        whole(F.col(text)).alias("text"), F.monotonically_increasing_id().alias("place"),
    ).withColumn("turn", F.xxhash64("text"))
    order = [F.asc_nulls_first("doc_id"), F.asc("turn"), F.asc("place")]
    n = parts_for(docs.sparkSession, text_bytes(own), shard_bytes)
    dealt = own.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("turn", "place")
    dealt = dealt.withColumn("shard", F.spark_partition_id())
    carried = ["doc_id", *names, "shard"]
    schema = StructType([*[dealt.schema[c] for c in carried], *StructType.fromDDL("at long, n_tokens int, ids array<int>").fields])

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for row in rows:
            texts = Texts.of(row.column("text"))
            for a, b in batches(np.diff(texts.begins), SLICE_BYTES):
                begins = texts.begins[a : b + 1]
                ids, counts = vocabulary(path).encode(Texts(texts.data[begins[0] : begins[-1]], begins - begins[0]))
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
                ends = at + np.cumsum(counts)
                offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                old = [row.column(c).slice(a, b - a) for c in carried]
                listed = pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*old, pa.array(ends - counts), pa.array(counts.astype(np.int32)), listed], schema.names)
                at = int(ends[-1])

    return dealt.mapInArrow(encode, schema).toDF("doc_id", *keep, *META, "ids")


def write(
    docs: DataFrame,
    path: str,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: Sequence[str] = (),
    end_id: int = END_ID,
    ids_encoding: str = "dictionary",
    shard_bytes: int = SHARD_BYTES,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
    codec: str = "zstd",
) -> str:
    """Write the token files of ``docs`` by the vocabulary ``path`` into ``folder``, which must not exist; the folder."""
    taken = {"doc_id", "ids", *META}
    if len({c.lower() for c in keep} | taken) < len(keep) + len(taken):
        raise ValueError(f"keep: names must differ from one another and from {sorted(taken)}")
    if ids_encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding of ids: {ids_encoding}")
    options = {
        "compression": codec,
        "parquet.writer.version": "PARQUET_2_0",  # with it, integers without a dictionary are delta-encoded
        "parquet.block.size": row_group_bytes,
        "parquet.page.size": page_bytes,
        "parquet.enable.dictionary#ids.list.element": str(ids_encoding == "dictionary").lower(),
        **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", *META)},
    }
    encoded(docs, path, doc_id, text, keep, end_id, shard_bytes).write.options(**options).parquet(folder)
    return folder


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """All columns but the ids, which are not read."""
    return spark.read.parquet(folder).drop("ids")


def documents(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """The rows with an id from ``first`` to ``last``; other row groups and pages are skipped by their bounds."""
    return spark.read.parquet(folder).where(F.col("doc_id").between(first, last))


def shard_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, start, total): the ids before each shard and in it; the shards' totals are summed by blocks."""
    total = metadata(spark, folder).groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    total = kept(total.withColumn("block", F.floor(F.col("shard") / BLOCK)))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    blocks = total.groupBy("block").agg(F.sum("total").alias("sum")).withColumn("base", F.coalesce(F.sum("sum").over(before), none))
    inside = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = total.withColumn("inside", F.coalesce(F.sum("total").over(inside), none))
    return within.join(blocks.select("block", "base"), "block").select("shard", (F.col("base") + F.col("inside")).alias("start"), "total")


def span(spark: SparkSession, folder: str, first: int, count: int) -> DataFrame:
    """(doc_id, start, ids) of the stretch of ``count`` ids from the place ``first`` on; ends are cut to it."""
    last = first + count
    shards = shard_starts(spark, folder).where((F.col("start") < last) & (F.col("start") + F.col("total") > first))
    rows = []
    for s in shards.collect():  # the shards of one span
        here = spark.read.parquet(folder).where(
            (F.col("shard") == s["shard"]) & (F.col("at") < last - s["start"]) & (F.col("at") + F.col("n_tokens") > first - s["start"])
        )
        rows.append(here.withColumn("start", F.col("at") + s["start"]))
    if not rows:
        return spark.createDataFrame([], "doc_id long, start long, ids array<int>")
    found = rows[0]
    for r in rows[1:]:
        found = found.unionByName(r)
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0))
    size = F.least(F.lit(last) - F.col("start"), F.col("n_tokens")) - skip
    return found.select("doc_id", (F.col("start") + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), size.cast("int")).alias("ids"))


def with_start(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """``rows`` (with shard and at) with ``start``, the ids of all documents before each."""
    base = starts.select("shard", F.col("start").alias("base"))
    return spread_lookup(rows, kept(base), "shard", F.col("at")).withColumn("start", (F.col("base") + F.col("at")).cast("long")).drop("base")


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """``metadata`` with ``crc32`` of each document's ids as little-endian 32-bit integers, from the stored ids."""
    stored = spark.read.parquet(folder)
    others = [c for c in stored.columns if c != "ids"]
    schema = StructType([stored.schema[c] for c in others]).add("crc32", "long")

    def summed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            ids = row.column("ids")
            at = np.asarray(ids.offsets)
            data = memoryview(np.ascontiguousarray(np.asarray(ids.values, "<i4")).view(np.uint8))
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[row.column(c) for c in others], pa.array(sums, pa.int64())], schema.names)

    return stored.mapInArrow(summed, schema)


def new_folder(spark: SparkSession, name: str = "token-files") -> str:
    """A folder that does not exist yet, where the cluster keeps checkpoints."""
    return f"{ready(spark).sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"

