"""Substring dedup on bytes by interval expansion over Burrows-Wheeler transforms.

Every 50-byte string has a winnowed anchor (its gram of GRAM bytes with the
least hash), so strings that repeat have an anchor in several documents. The
stretches around such anchors are dealt out by anchor, equal ones of a part
only once, and each task indexes blocks of them: suffixes are sorted, and
breadth-first backward extension on the block's Burrows-Wheeler transform
derives where neighbouring suffixes differ, by increasing length of the common
prefix, stopping at 50. What is left between two such borders is one 50-byte
string; the least id among its documents tells who keeps it.

An anchor at more than HOT places is dealt out by whole strings, which spread it
over all tasks. Blocks hold whole groups, about BLOCK_BYTES in sum. Only ids and
compressed bytes are sent; hashes and anchors are derived from the bytes again.

Nulls: a null text is the empty one; a null id counts as less than any other.
Rows with one id do not cost each other bytes, and equal rows get equal
results. Texts of fewer than 50 bytes stay whole; a very long text is one row,
worked on in batches. Of equal strings the least id keeps its own, wherever in
the document they are. Empty tables give empty results; other columns pass
through, but for the names __part, __id, __text, __n_bytes, __n_removed,
__n_spans and __kept, which are taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from creditlake.llm.grams import Grams, Runs, Texts, U, batches, byte_units, chained, covered, mixed, spans
from creditlake.llm.repeats import as_table, cut_by, dealt, find, group_heads, own_id, read_shared, runs_of, shared_anchors

LENGTH = 50
GRAM = 16
#: Small enough that the arrays of a batch or block stay in a core's cache.
BATCH_BYTES = 1 << 17
BLOCK_BYTES = 150_000
HOT = 20_000
#: Lengths of prefixes that are sorted and told apart before the expansion begins.
FIRST = 8
#: Bytes of the hashes that make up a stretch's, and the odd base of their weights with its inverse modulo 2**64.
SHORT = 4
BASE = U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
TYPES = {"stretch": U, "flags": np.uint8, "size": np.uint8, "runs": np.uint8, "run": np.uint8, "hot": U}
STRETCHES = ("doc", "flags", "size", "data")
ANSWERS = ("stretch", "runs", "run", "least", "hot")
SEVERAL, SINGLE = 1, 2  # flags: several documents of the part; a string by itself


def stack(table: pa.Table, *names: str) -> list[np.ndarray]:
    """The arrays of all rows of a table, one after the other."""
    return [np.concatenate([np.frombuffer(x, TYPES[n]) for x in table.column(n).to_pylist()] or [np.zeros(0, TYPES[n])]) for n in names]


def planes(ids: np.ndarray) -> bytes:
    """64-bit ids byte by byte: the high bytes, mostly equal, then compress to nothing."""
    return ids.astype(np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def unplanes(table: pa.Table, name: str) -> np.ndarray:
    ids = [np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(8, -1).T).view(np.int64).ravel() for x in table.column(name).to_pylist()]
    return np.concatenate(ids) if ids else np.zeros(0, np.int64)


def binaries(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} binary" for n in names)


def suffix_order(text: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and for each whether its first FIRST bytes differ from those of the one before.

    ``left`` counts the bytes before the end of the own stretch; what lies
    behind does not count, and equal suffixes stay in the order of the text.
    """
    key, size = text.astype(U), 1
    while size < FIRST:
        ahead = np.zeros_like(key)
        ahead[:-size] = key[size:]
        key = (key << U(8 * size)) | np.where(left >= size, ahead, U(0))
        size *= 2
    prefix, most = key, int(left.max(initial=0))
    order = np.argsort(key, kind="stable")
    new = np.append(True, prefix[order][1:] != prefix[order][:-1])
    differs = new
    n = len(text)
    while size <= most:
        # Only suffixes that still tie are sorted again, by the ranks of what follows; two at a time, if they fit 63 bits.
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            break
        at = order[tied]
        parts = 3 if n < (1 << 21) - 1 else 2
        key = rank[at]
        for k in range(1, parts):
            ahead = np.where(left[at] >= k * size, rank[np.minimum(at + k * size, n - 1)], 0)
            key = key * (n + 1) + ahead
        sort = np.argsort(key, kind="stable")
        order[tied], key = at[sort], key[sort]
        new = new.copy()
        new[tied[1:]] |= key[1:] != key[:-1]
        size *= parts
    return order, differs


def borders(text: np.ndarray, order: np.ndarray, border: np.ndarray, length: int) -> np.ndarray:
    """Where neighbours in suffix order differ within ``length`` bytes, by backward extension from FIRST on."""
    n = len(text)
    before = text[order - 1]  # the transform; 0 where a stretch begins
    by_byte = np.argsort(before, kind="stable")
    step = np.empty(n, np.int64)
    step[by_byte] = np.arange(n)  # from a suffix to the one longer by the byte before it
    following, prior = np.full(n, n), np.full(n, -1)
    same = before[by_byte[1:]] == before[by_byte[:-1]]
    following[by_byte[:-1][same]] = by_byte[1:][same]
    prior[by_byte[1:][same]] = by_byte[:-1][same]
    border = np.append(border, True)
    begin = np.flatnonzero(border[:-1])
    end = np.append(begin[1:], n)
    for _ in range(FIRST, length):
        sizes = end - begin
        at = spans(begin, sizes)
        byte = before[at] > 0
        first = at[byte & (prior[at] < np.repeat(begin, sizes))]
        last = at[byte & (following[at] >= np.repeat(end, sizes))]
        # The interval of a byte before a prefix runs from its first to its last occurrence in the prefix's.
        begin, end = np.sort(step[first]), np.sort(step[last]) + 1
        fresh = ~border[end]
        begin, end = begin[fresh], end[fresh]
        border[end] = True
        if not len(begin):
            break
    return border[:-1]


def least_ids(data: np.ndarray, sizes: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For every ``length``-byte string of the stretches, in order, the least id of a stretch that holds it."""
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(len(data) + len(sizes), np.uint8)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = data + 1  # UTF-8 has no byte 255
    left = np.repeat(ends, sizes + 1) - np.arange(len(text))
    order, border = suffix_order(text, left)
    head = np.flatnonzero(borders(text, order, border, length))
    whole = left >= length
    owner = np.repeat(ids, sizes + 1)
    value = np.where(whole, owner, np.iinfo(np.int64).max)[order]
    out = np.empty(len(text), np.int64)
    out[order] = np.repeat(np.minimum.reduceat(value, head), np.diff(np.append(head, len(text))))
    return out[whole]


def stretch_hash(grams: Grams, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each stretch, from running sums of all hashes of SHORT bytes, weighted by powers of their place."""
    hashes = chained(grams.hashes, SHORT)
    if not len(first):
        return np.zeros(0, U)
    sums = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * np.cumprod(np.full(len(hashes), BASE)), out=sums[1:])
    # The inverse power moves a stretch's sum to place 0, wherever it begins.
    back = np.cumprod(np.full(len(hashes), BASE_INVERSE))
    return mixed((sums[first + sizes - SHORT + 1] - sums[first]) * back[first] + sizes.astype(U))


def single(runs: Runs, hot: np.ndarray) -> tuple[Runs, np.ndarray]:
    """The runs, those that are ``hot`` cut into runs of one window each; and which ones are cut."""
    sizes = np.where(hot, runs.last - runs.first + 1, 1)
    again = np.repeat(np.arange(len(hot)), sizes)
    cut = hot[again]
    first = np.where(cut, spans(runs.first, sizes), runs.first[again])
    return Runs(first, np.where(cut, first, runs.last[again]), runs.anchor[again], runs.hash[again]), cut


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """``docs`` without the text, with ``__n_bytes``, ``__n_removed``, ``__n_spans`` and ``__kept`` (binary)."""
    own, n = dealt(docs, doc_id, text)
    shared = shared_anchors(own, n, byte_units, length, gram, BATCH_BYTES, hot)
    stretches_ddl = f"bucket int, part int, {binaries(STRETCHES)}"
    answers_ddl = f"part int, {binaries(ANSWERS)}"

    def stretches_of(table: pa.Table, only: np.ndarray | None, crowded: np.ndarray) -> Iterator[tuple]:
        """(first row, row after, units, runs, which are single strings, stretch hashes) of the anchors ``only`` (all, if None)."""
        for at, to, grams, runs in runs_of(Texts.of(table.column("__text")), byte_units, length, gram, BATCH_BYTES):
            if only is not None:
                runs = Runs(*[x[find(only, runs.hash >> U(17)) >= 0] for x in runs])
            runs, alone = single(runs, find(crowded, runs.hash >> U(17)) >= 0)
            yield at, to, grams, runs, alone, stretch_hash(grams, runs.first, runs.last - runs.first + length)

    def stretches(key: tuple, table: pa.Table, shares: pa.Table) -> pa.Table:
        ids, texts = own_id(table.column("__id")), Texts.of(table.column("__text"))
        found = []
        only, crowded = read_shared(shares)
        for at, _, grams, runs, alone, hashes in stretches_of(table, only, only[crowded]):
            begin = runs.first + texts.begins[at]
            found.append((hashes, runs.last - runs.first + length, ids[at + grams.owner[runs.first]], runs.hash, alone, begin))
        if not found:
            return as_table([], stretches_ddl)
        hashes, size, doc, anchor, alone, begin = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((doc, hashes))
        hashes, size, doc, anchor, alone, begin = (x[order] for x in (hashes, size, doc, anchor, alone, begin))
        head = group_heads(hashes)
        several = doc[np.append(head[1:], len(doc)) - 1] != doc[head] if len(doc) else doc[head] > 0
        hashes, size, doc, anchor, alone, begin = (x[head] for x in (hashes, size, doc, anchor, alone, begin))
        flags = (several * SEVERAL + alone * SINGLE).astype(np.uint8)
        bucket = np.where(alone, hashes >> U(20), anchor & U(0xFFFFFFFF)) % U(n)
        rows = []
        for b, mine in cut_by(bucket):
            data = pa.compress(texts.data[spans(begin[mine], size[mine])].tobytes(), "zstd", asbytes=True)
            row = {"bucket": b, "part": key[0].as_py(), "doc": planes(doc[mine]), "flags": flags[mine].tobytes()}
            rows.append(row | {"size": size[mine].astype(np.uint8).tobytes(), "data": data})
        return as_table(rows, stretches_ddl)

    def solved(table: pa.Table) -> pa.Table:
        """Answers for the stretches with a string that a document with a smaller id has."""
        flags, size = stack(table, "flags", "size")
        size, ids = size.astype(np.int64), unplanes(table, "doc")
        rows_of = [np.frombuffer(x, np.uint8) for x in table.column("size").to_pylist()]
        part = np.repeat(table.column("part").to_numpy(), [len(x) for x in rows_of])
        lengths = [int(x.sum()) for x in rows_of]
        data = [pa.decompress(x, k, "zstd", asbytes=True) for x, k in zip(table.column("data").to_pylist(), lengths, strict=True)]
        texts = Texts(np.frombuffer(b"".join(data), np.uint8), np.append(0, np.cumsum(size)))
        begin = texts.begins[:-1]
        anchors, hashes = [], []
        for at, to, grams, runs in runs_of(texts, byte_units, length, gram, BATCH_BYTES):  # a run a stretch
            anchors.append(runs.hash)
            hashes.append(stretch_hash(grams, runs.first, size[at:to]))
        anchor, stretch = np.concatenate(anchors), np.concatenate(hashes)
        alone = (flags & SINGLE) > 0
        group = np.where(alone, stretch, anchor)
        order = np.lexsort((ids, stretch, group))
        group, stretch, doc = group[order], stretch[order], ids[order]
        one = group_heads(group, stretch)
        stretch_of = np.repeat(np.arange(len(one)), np.diff(np.append(one, len(order))))
        # Blocks of whole groups, about BLOCK_BYTES of different stretches each.
        sizes = size[order[one]]
        group_begin = np.flatnonzero(np.append(True, group[one][1:] != group[one][:-1])) if len(one) else one
        group_bytes = np.add.reduceat(sizes, group_begin) if len(one) else sizes
        windows = sizes - length + 1
        least = np.empty(windows.sum(), np.int64)
        window_at = np.cumsum(windows) - windows
        for at, to in batches(group_bytes, BLOCK_BYTES):
            a, b = group_begin[at], group_begin[to] if to < len(group_begin) else len(one)
            block = texts.data[spans(begin[order[one[a:b]]], sizes[a:b])]
            least[window_at[a] : window_at[b - 1] + windows[b - 1]] = least_ids(block, sizes[a:b], doc[one[a:b]], length)
        # Runs of strings of a stretch with the same least id.
        of = np.repeat(np.arange(len(one)), windows)
        run = group_heads(of, least) if len(of) else of
        run_size, run_least = np.diff(np.append(run, len(of))), least[run]
        runs = np.bincount(of[run], minlength=len(one))
        run_at = np.cumsum(runs) - runs
        lowest = np.minimum.reduceat(run_least, run_at) if len(one) else run_least
        tell = np.flatnonzero((lowest[stretch_of] < doc) | ((flags[order] & SEVERAL) > 0))
        rows = []
        for p, mine in cut_by(part[order][tell]):
            mine = tell[mine]
            s = stretch_of[mine]
            got = spans(run_at[s], runs[s])
            crowded = np.unique(anchor[order][mine][alone[order][mine]] >> U(17))
            arrays = (stretch[mine], runs[s].astype(np.uint8), run_size[got].astype(np.uint8))
            sent = {k: v.tobytes() for k, v in zip(ANSWERS, arrays, strict=False)}
            rows.append({"part": p, "least": planes(run_least[got]), "hot": crowded.tobytes()} | sent)
        return as_table(rows, answers_ddl)

    out = StructType(own.schema.fields[3:])
    for name, kind in (("__n_bytes", "long"), ("__n_removed", "long"), ("__n_spans", "long"), ("__kept", "binary")):
        out = out.add(name, kind)

    def removed(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = own_id(table.column("__id")), Texts.of(table.column("__text"))
        stretch, counts, run, crowded = stack(answers, "stretch", "runs", "run", "hot")
        least_of, counts = unplanes(answers, "least"), counts.astype(np.int64)
        runs_at = np.cumsum(counts) - counts
        order = np.argsort(stretch)
        known, crowded = stretch[order], np.unique(crowded)
        n_removed, n_spans, kept = [], [], []
        for at, to, grams, runs, _, hashes in stretches_of(table, None, crowded):
            found = find(known, hashes)
            here = np.flatnonzero(found >= 0)
            answer = order[found[here]]
            got = spans(runs_at[answer], counts[answer])
            size = run[got].astype(np.int64)
            start = spans(runs.first[here], runs.last[here] - runs.first[here] + 1)
            least = np.repeat(least_of[got], size)
            start = start[least < ids[at + grams.owner[start]]]
            gone = covered(start, length, len(grams.hashes))
            begins = texts.begins[at : to + 1] - texts.begins[at]
            lost = np.concatenate([[0], np.cumsum(gone)])[begins]
            for i in range(to - at):
                n_removed.append(int(lost[i + 1] - lost[i]))
                body = texts.text(at + i)
                spans_here = 0
                if n_removed[-1]:
                    mask = gone[begins[i] : begins[i + 1]]
                    spans_here = int(mask[0]) + int(np.count_nonzero(mask[1:] & ~mask[:-1]))
                    body = np.frombuffer(body, np.uint8)[~mask].tobytes()
                n_spans.append(spans_here)
                kept.append(body)
        new = [pa.array(np.diff(texts.begins), pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())]
        return pa.Table.from_arrays([*[table.column(i) for i in range(3, table.num_columns)], *new], out.names)

    parts = own.groupBy("__part")
    dealt_out = parts.cogroup(shared.groupBy("part")).applyInArrow(stretches, stretches_ddl)
    answers = dealt_out.groupBy("bucket").applyInArrow(solved, answers_ddl)
    return parts.cogroup(answers.groupBy("part")).applyInArrow(removed, out)
