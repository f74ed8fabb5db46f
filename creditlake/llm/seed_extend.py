"""Substring dedup by seed and extend, on words.

Seeds are winnowed anchors: of any 50 consecutive words, the gram of GRAM
words with the least hash. Documents are joined on equal anchors. In place of
following each match word by word to both sides, every 50-word window around a
shared anchor is hashed, and windows that match one of a document with a
smaller id are that document's repeats; where they overlap or touch, their union
is the maximal repeat, whose words go. Anchors and windows travel once a part,
while comparing pairs of documents would grow with the square of a passage's
copies.

Equal windows have equal anchors, so none is missed. An anchor or window of
many documents travels as one entry for each part of the corpus. Windows are
compared by 64 bits of their words and 16 of their anchor.

Nulls: a null text has no words; a null id counts as less than any other. Rows
with one id do not cost each other words, and equal rows get equal results.
Texts of fewer than 50 words stay whole; a very long text is one row, worked on
in batches. Of equal windows the least id keeps its own. Empty tables give empty
results; other columns pass through, but for the names __part, __id, __text,
__n_words, __n_removed and __kept, which are taken.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creditlake.llm.grams import Texts, U, chained, covered, spans, word_units
from creditlake.llm.repeats import as_table, cut_by, dealt, find, group_heads, own_id, read_shared, runs_of, shared_anchors

LENGTH = 50
GRAM = 20
BATCH_BYTES = 1 << 18
WINDOWS = "bucket int, part int, window binary, anchor binary, doc binary, several binary"
ANSWERS = "part int, window binary, anchor binary, doc binary"
TYPES = {"window": U, "anchor": np.uint16, "doc": np.int64, "several": bool, "part": np.int32}


def stacked(table: pa.Table, *names: str) -> list[np.ndarray]:
    """The arrays of all rows of a table, one after the other."""
    return [np.concatenate([np.frombuffer(x, TYPES[n]) for x in table.column(n).to_pylist()] or [np.zeros(0, TYPES[n])]) for n in names]


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", untouched: bool = False, length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """``docs`` without the text, with ``__n_words``, ``__n_removed`` and ``__kept``.

    Kept are the words that stay, joined by one space; with ``untouched``, a
    text that loses no word is kept as it is.
    """
    own, n = dealt(docs, doc_id, text)
    shared = shared_anchors(own, n, word_units, length, gram, BATCH_BYTES, 1 << 62)

    def windows_of(table: pa.Table, only: np.ndarray | None):
        """(first row, units, start, hash, anchor) of the windows with one of the anchors ``only`` (all, if None)."""
        for at, to, grams, runs in runs_of(Texts.of(table.column("__text")), word_units, length, gram, BATCH_BYTES):
            if only is not None:
                runs = type(runs)(*[x[find(only, runs.hash >> U(17)) >= 0] for x in runs])
            sizes = runs.last - runs.first + 1
            start = spans(runs.first, sizes)
            hashes = chained(grams.hashes, length)
            anchor = np.repeat((runs.hash & U(0xFFFF)).astype(np.uint16), sizes)
            yield at, to, grams, start, hashes[start] if len(start) else np.zeros(0, U), anchor

    def extended(key: tuple, table: pa.Table, shares: pa.Table) -> pa.Table:
        ids, only = own_id(table.column("__id")), read_shared(shares)[0]
        found = [(h, a, ids[at + grams.owner[s]]) for at, _, grams, s, h, a in windows_of(table, only)]
        window, anchor, doc = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0),) * 3
        if not len(window):
            return as_table([], WINDOWS)
        order = np.lexsort((doc, anchor, window))
        window, anchor, doc = window[order], anchor[order], doc[order]
        head = group_heads(window, anchor)
        last = doc[np.append(head[1:], len(doc)) - 1]
        window, anchor, doc = window[head], anchor[head], doc[head]
        several = last != doc
        rows = [
            {"bucket": b, "part": key[0].as_py(), "window": window[m].tobytes(), "anchor": anchor[m].tobytes(), "doc": doc[m].tobytes(), "several": several[m].tobytes()}
            for b, m in cut_by((window >> U(20)) % U(n))
        ]
        return as_table(rows, WINDOWS)

    def first_of(table: pa.Table) -> pa.Table:
        """Answers for the windows that a document with a smaller id has."""
        window, anchor, doc, several = stacked(table, "window", "anchor", "doc", "several")
        sizes = [len(x) // 8 for x in table.column("window").to_pylist()]
        part = np.repeat(table.column("part").to_numpy(), sizes)
        order = np.lexsort((doc, anchor, window))
        window, anchor, doc, several, part = window[order], anchor[order], doc[order], several[order], part[order]
        head = group_heads(window, anchor)
        first = np.repeat(doc[head], np.diff(np.append(head, len(doc))))
        tell = np.flatnonzero((first < doc) | several)
        rows = [
            {"part": p, "window": window[m].tobytes(), "anchor": anchor[m].tobytes(), "doc": first[m].tobytes()}
            for p, m in ((p, tell[i]) for p, i in cut_by(part[tell]))
        ]
        return as_table(rows, ANSWERS)

    out = StructType(own.schema.fields[3:]).add("__n_words", "long").add("__n_removed", "long").add("__kept", "string")

    def removed(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = own_id(table.column("__id")), Texts.of(table.column("__text"))
        window, anchor, first = stacked(answers, "window", "anchor", "doc")
        order = np.argsort(window)
        window, anchor, first = window[order], anchor[order], first[order]
        n_words, n_removed, kept = [], [], []
        for at, to, grams, start, hashes, marks in windows_of(table, None):
            found = find(window, hashes)
            known = np.flatnonzero(found >= 0)
            found, start = found[known], start[known]
            good = (anchor[found] == marks[known]) & (first[found] < ids[at + grams.owner[start]])
            gone = covered(start[good], length, len(grams.hashes))
            heads = np.searchsorted(grams.owner, np.arange(to - at + 1))
            lost = np.concatenate([[0], np.cumsum(gone)])[heads]
            for i in range(to - at):
                words = texts.text(at + i).split()
                n_words.append(len(words))
                n_removed.append(int(lost[i + 1] - lost[i]))
                if n_removed[-1]:
                    words = compress(words, ~gone[heads[i] : heads[i + 1]])
                kept.append(b" ".join(words) if n_removed[-1] or not untouched else None)
        left = pa.array(kept, pa.binary()).cast(pa.string())
        if untouched:
            left = pc.coalesce(left, table.column("__text").cast(pa.string()))
        new = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), left]
        return pa.Table.from_arrays([*[table.column(i) for i in range(3, table.num_columns)], *new], out.names)

    parts = own.groupBy("__part")
    windows = parts.cogroup(shared.groupBy("part")).applyInArrow(extended, WINDOWS)
    answers = windows.groupBy("bucket").applyInArrow(first_of, ANSWERS)
    return parts.cogroup(answers.groupBy("part")).applyInArrow(removed, out)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with the texts (and, if there, their lengths) that stay."""
    cut = remove_repeats(docs, doc_id, text, untouched=True)
    size = F.when(F.col("__n_removed") > 0, F.length("__kept").cast("long"))
    columns = {text: F.col("__kept")}
    if n_chars in docs.columns:
        columns[n_chars] = F.coalesce(size, F.col(f"`{n_chars}`"))
    return cut.select(*[columns.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
