"""What both kinds of substring dedup share: documents dealt into parts, and anchors that lie in several documents.

Documents are dealt into parts of about PART_BYTES by a hash of their row.
Anchors leave a task as arrays, one for each bucket of the anchors' hashes,
and each at most once for a batch and part; a bucket's task finds those that
occur in several documents and sends each part its own. A frequent anchor is
thus one entry a part, however many documents have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import kept, parts_for, shipped, text_bytes, whole
from creditlake.llm.grams import Grams, Runs, Texts, U, batches, winnowed

PART_BYTES = 8 << 20
ANCHORS = "bucket int, low binary, high binary, part binary, places binary"
SHARED = "part int, low binary, high binary"
ID_SHIFT = U(17)
NO_ID = -(1 << 63)


def own_id(column: pa.ChunkedArray) -> np.ndarray:
    """Document ids for comparisons; a null id counts as less than any other."""
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy()


def dealt(docs: DataFrame, doc_id: str, text: str, part_bytes: int = PART_BYTES) -> tuple[DataFrame, int]:
    """``docs`` as ``__part``, ``__id``, ``__text`` and the other columns, and the number of parts."""
    n = parts_for(shipped(docs.sparkSession), text_bytes(docs, text), part_bytes)
    part = F.pmod(F.xxhash64(F.col(doc_id), whole(F.col(text))), F.lit(n)).cast("int")
    front = [part.alias("__part"), F.col(doc_id).cast("long").alias("__id"), F.col(text).cast("string").alias("__text")]
    return docs.select(*front, *[F.col(f"`{c}`") for c in docs.columns if c != text]), n


def split(value: np.ndarray) -> tuple[bytes, bytes]:
    """48-bit values as two byte strings."""
    return (value & U(0xFFFFFFFF)).astype(np.uint32).tobytes(), (value >> U(32)).astype(np.uint16).tobytes()


def unsplit(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, np.uint32).astype(U) | (np.frombuffer(high, np.uint16).astype(U) << U(32))


def cut_by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(key, indexes with that key), ascending."""
    if not len(key):
        return
    order = np.argsort(key, kind="stable")
    keys, heads = np.unique(key[order], return_index=True)
    yield from zip(keys.tolist(), np.split(order, heads[1:]), strict=True)


def as_table(rows: list[dict], schema: str) -> pa.Table:
    """An Arrow table by a schema of "name int" and "name binary"."""
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return pa.Table.from_pylist(rows, pa.schema([(n, pa.int32() if kind == "int" else pa.binary()) for n, kind in fields]))


def group_heads(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new group of equal keys begins."""
    n = len(sorted_keys[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for k in sorted_keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def runs_of(texts: Texts, units: Callable[[Texts], Grams], length: int, gram: int, most: int) -> Iterator[tuple[int, int, Grams, Runs]]:
    """(first row, last row + 1, units, anchor runs) of batches of about ``most`` bytes."""
    for at, to in batches(np.diff(texts.begins), most):
        begins = texts.begins[at : to + 1]
        part = Texts(texts.data[begins[0] : begins[-1]], begins - begins[0])
        grams = units(part)
        yield at, to, grams, winnowed(grams, length, gram)


def find(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in ``sorted_values``, or -1."""
    if not len(sorted_values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)


def shared_anchors(
    docs: DataFrame, n_parts: int, units: Callable[[Texts], Grams], length: int, gram: int, batch_bytes: int, hot: int
) -> DataFrame:
    """For each part the anchors that occur in several documents: 47 bits of the hash, and a bit set for those at more than ``hot`` places."""
    buckets = n_parts
    kind = np.uint16 if n_parts < 1 << 16 else np.uint32

    def anchors(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            part = row.column("__part").to_numpy()
            hashes, owners = [], []
            for at, _, grams, runs in runs_of(Texts.of(row.column("__text")), units, length, gram, batch_bytes):
                hashes.append(runs.hash)
                owners.append(grams.owner[runs.anchor] + at)
            if not hashes:
                continue
            value, owner = np.concatenate(hashes), np.concatenate(owners)
            at = part[owner]
            order = np.lexsort((owner, at, value))
            value, owner, at = value[order], owner[order], at[order]
            head = group_heads(value, at)
            places = np.diff(np.append(head, len(value)))
            value, at, several = value[head], at[head], owner[head] != owner[head + places - 1]
            entry = ((value >> ID_SHIFT) << U(1)) | several
            places = np.minimum(places, 0xFFFF).astype(np.uint16)
            for bucket, mine in cut_by((value & U(0xFFFFFFFF)) % U(buckets)):
                low, high = split(entry[mine])
                sent = {"bucket": bucket, "low": low, "high": high, "part": at[mine].astype(kind).tobytes(), "places": places[mine].tobytes()}
                yield from as_table([sent], ANCHORS).to_batches()

    def several(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("low", "high", "part", "places")]
        entry = np.concatenate([unsplit(a, b) for a, b in zip(*columns[:2], strict=True)])
        part = np.concatenate([np.frombuffer(p, kind) for p in columns[2]])
        places = np.concatenate([np.frombuffer(p, np.uint16) for p in columns[3]])
        value = entry >> U(1)
        order = np.argsort(value, kind="stable")
        value, part, multi, places = value[order], part[order], (entry[order] & U(1)) > 0, places[order]
        head = group_heads(value)
        size = np.diff(np.append(head, len(value)))
        good = (size > 1) | np.logical_or.reduceat(multi, head)
        crowded = np.add.reduceat(places.astype(np.int64), head) > hot
        stay = np.repeat(good, size)
        value = (value << U(1)) | np.repeat(crowded, size)
        value, part = value[stay], part[stay]
        rows = [(p, *split(np.sort(value[mine]))) for p, mine in cut_by(part)]
        return as_table([dict(zip(("part", "low", "high"), r, strict=True)) for r in rows], SHARED)

    found = docs.select("__part", "__text").mapInArrow(anchors, ANCHORS)
    return kept(found.groupBy("bucket").applyInArrow(several, SHARED))


def read_shared(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A part's shared anchors (47 bits, ascending) and which of them are at very many places."""
    entries = [unsplit(a, b) for a, b in zip(table.column("low").to_pylist(), table.column("high").to_pylist(), strict=True)]
    value = np.sort(np.concatenate(entries)) if entries else np.zeros(0, U)
    value = value[group_heads(value >> U(1))] if len(value) else value
    return value >> U(1), (value & U(1)) > 0
