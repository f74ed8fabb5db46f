"""Byte-level BPE encoding and decoding; long texts by tree concatenation.

Short texts are encoded where they are read. A long text is cut into pieces,
which are encoded in parallel over the cluster: at borders between pre-tokens,
where the pieces' tokens simply follow each other, and, inside a pre-token that
is longer than a piece, in halves of halves. Two halves are put together by
encoding a window around the join, which grows until its first token is one
that the left half has there and its last token one that the right half has
there. A token sequence is the BPE encoding of its bytes exactly if every two
neighbours are the encoding of theirs, so the result is that of the whole.

The vocabulary is read from a tokenizers JSON file (byte-level BPE, no
normaliser); its added tokens are matched inside texts, as by that library.

Nulls: a null text is the empty one and has no tokens. Repeated rows are
encoded one by one. Empty tables give empty results; other columns of the input
are carried through if they are named in ``keep``.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from creditlake.llm.common import shipped, whole
from creditlake.llm.grams import batches as cut_at

LONG_CHARS = 1 << 16
PIECE_CHARS = 1 << 14
FIRST_WINDOW = 4
PORTION_BYTES = 1 << 20
#: The byte-level pre-tokeniser's pattern (a fixed value of that format).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The format's printable stand-ins of the 256 bytes."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Codec:
    def __init__(self, path: str):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        byte = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ranks = {bytes(byte[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        self.bytes_of = {i: b for b, i in self.ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.text_of = {i: str(i) for i in self.bytes_of}
        self.words = regex.compile(PATTERN)
        self.marks = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.all = tiktoken.Encoding("all", pat_str=PATTERN, mergeable_ranks=self.ranks, special_tokens=self.special)

    @cached_property
    def lone(self):
        """The encoding of one pre-token, or of parts of one; only long texts need it."""
        import tiktoken

        return tiktoken.Encoding("lone", pat_str=r"(?s:.+)", mergeable_ranks=self.ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.all.encode(text, allowed_special="all")

    def decode(self, ids: list[int]) -> str:
        return self.all.decode_bytes(ids).decode("utf-8", "replace")

    def pieces(self, text: str, most: int = PIECE_CHARS) -> Iterator[tuple[int, bool, str]]:
        """(unit, lone, text): pieces in order; those of one unit are parts of one pre-token."""
        unit, group, size = 0, [], 0

        def flush() -> Iterator[tuple[int, bool, str]]:
            nonlocal unit, group, size
            # White space at the end would be split otherwise without what follows it: it goes by itself.
            end = len(group)
            while end and group[end - 1].isspace():
                end -= 1
            if end:
                yield unit, False, "".join(group[:end])
                unit += 1
            for word in group[end:]:
                yield unit, True, word
                unit += 1
            group, size = [], 0

        at = 0
        for mark in [*self.marks.finditer(text), None]:
            for match in self.words.finditer(text, at, mark.start() if mark else len(text)):
                word = match.group()
                if len(word) > most:
                    yield from flush()
                    for part in halves(word, most):
                        yield unit, True, part
                    unit += 1
                    continue
                group.append(word)
                size += len(word)
                if size >= most:
                    yield from flush()
            yield from flush()
            if mark:
                yield unit, False, mark.group()
                unit += 1
                at = mark.end()

    def encode_piece(self, lone: bool, text: str) -> list[int]:
        return self.lone.encode_ordinary(text) if lone else self.encode(text)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbouring parts of one pre-token from the parts' encodings.

        A window may begin or end within a character, so it is encoded as bytes.
        """
        width = FIRST_WINDOW
        while True:
            a, b = left[-width:], right[:width]
            window = self.lone._encode_single_piece(b"".join(self.bytes_of[i] for i in a + b))
            left_agrees = len(a) == len(left) or window[0] == a[0]
            right_agrees = len(b) == len(right) or window[-1] == b[-1]
            if left_agrees and right_agrees:
                return left[: len(left) - len(a)] + window + right[len(b) :]
            width *= 2

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        """All parts of one pre-token, joined as a tree."""
        parts = [p for p in parts if p]
        while len(parts) > 1:
            pairs = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
            parts = pairs + parts[len(pairs) * 2 :]
        return parts[0] if parts else []


def halves(text: str, most: int) -> Iterator[str]:
    if len(text) <= most:
        yield text
    else:
        yield from halves(text[: len(text) // 2], most)
        yield from halves(text[len(text) // 2 :], most)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def portions(batches: Iterator[pa.RecordBatch], text: str, most: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of text, so that tokens of few texts are held at once."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at, to in cut_at(sizes, most):
            yield batch.slice(at, to - at)


def emit_ids(_: Codec, ids: list[int]) -> tuple:
    return (np.asarray(ids, np.int32),)


def emit_digests(vocabulary: Codec, ids: list[int]) -> tuple:
    """Count and digests of the ids, and the digest of the text decoded from them."""
    listed = ",".join(map(vocabulary.text_of.__getitem__, ids))
    decoded = vocabulary.decode(ids)
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def emit_ids_and_digest(vocabulary: Codec, ids: list[int]) -> tuple:
    return len(ids), np.asarray(ids, np.int32), hashlib.sha256(vocabulary.decode(ids).encode()).hexdigest()


def encode(
    docs: DataFrame,
    path: str,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    emit: Callable[[Codec, list[int]], tuple] = emit_ids,
    emitted: str = "ids array<int>",
    long_chars: int = LONG_CHARS,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """The columns ``keep`` of each row, and what ``emit`` makes of its tokens."""
    shipped(docs.sparkSession)
    names = [f"__k{i}" for i in range(len(keep))]
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], whole(F.col(text)).alias("__text"))
    made = StructType.fromDDL(emitted)
    keys = StructType([own.schema[n] for n in names])
    result = StructType(keys.fields + made.fields)
    piece = StructType.fromDDL("seq int, unit int, lone boolean, piece string")
    part = StructType.fromDDL("seq int, unit int, ids binary")

    kinds = {f.name: to_arrow_schema(StructType([f])).field(0).type for f in [*made.fields, *piece.fields]}

    def rows(columns: dict[str, list], schema: StructType) -> list[pa.Array]:
        return [pa.array(columns[n], kinds[n]) for n in schema.names]

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "__text"):
            out = [emit(codec(path), codec(path).encode(t)) for t in batch.column("__text").to_pylist()]
            new = rows({f.name: [r[i] for r in out] for i, f in enumerate(made.fields)}, made)
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *new], result.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, t in enumerate(batch.column("__text")):
                pieces = list(codec(path).pieces(t.as_py(), piece_chars))
                same = pa.array([i] * len(pieces), pa.int64())
                columns = {"seq": list(range(len(pieces)))} | {n: [p[k] for p in pieces] for k, n in enumerate(piece.names[1:])}
                old = [batch.column(n).take(same) for n in ("uid", *names)]
                yield pa.RecordBatch.from_arrays([*old, *rows(columns, piece)], ["uid", *names, *piece.names])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, "piece"):
            lone, texts = batch.column("lone").to_pylist(), batch.column("piece").to_pylist()
            ids = [np.asarray(codec(path).encode_piece(x, t), np.int32).tobytes() for x, t in zip(lone, texts, strict=True)]
            old = ["uid", *names, "seq", "unit"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in old], pa.array(ids, pa.binary())], [*old, "ids"])

    def joined(group: pa.Table) -> pa.Table:
        group = group.sort_by("seq")
        ids: list[int] = []
        units: dict[int, list[list[int]]] = {}
        for unit, x in zip(group.column("unit").to_pylist(), group.column("ids").to_pylist(), strict=True):
            units.setdefault(unit, []).append(np.frombuffer(x, np.int32).tolist())
        for unit in sorted(units):
            ids += codec(path).concatenate(units[unit])
        out = emit(codec(path), ids)
        new = rows({f.name: [out[i]] for i, f in enumerate(made.fields)}, made)
        return pa.Table.from_arrays([*[group.column(n).slice(0, 1) for n in names], *new], result.names)

    size = F.length("__text")
    few = own.where(size <= long_chars).mapInArrow(short, result)
    long = own.where(size > long_chars).withColumn("uid", F.monotonically_increasing_id())
    uid = StructType([long.schema["uid"], *keys.fields])
    pieces = long.select("uid", *names, "__text").mapInArrow(cut, StructType(uid.fields + piece.fields))
    parts = pieces.repartition("uid", "seq").mapInArrow(encoded, StructType(uid.fields + part.fields))
    many = parts.groupBy("uid").applyInArrow(joined, result)
    return few.unionByName(many).toDF(*keep, *made.names)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with its ids replaced by the text that they stand for."""
    shipped(encoded.sparkSession)
    others = [c for c in encoded.columns if c != ids]
    schema = StructType([encoded.schema[c] for c in others]).add(out, "string")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if x is None else codec(path).decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in others], pa.array(made, pa.string())], schema.names)

    return encoded.mapInArrow(texts, schema)
