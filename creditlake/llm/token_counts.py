"""Token counts by rank-synchronous merging of ragged arrays.

A batch of texts becomes one array of code points, cut into pre-tokens where no
piece of the vocabulary can reach across. Distinct pre-tokens are held as a
ragged array of symbols; each round merges, in every sequence at once, the pair
of lowest rank, until no pair is in the vocabulary. The surviving symbols are
the tokens; a character outside the vocabulary counts as its UTF-8 bytes.

Works for sentencepiece BPE models with byte fallback and identity
normalisation; the segmenter compares itself with the library on fixed samples
when it is loaded, and raises if they differ.

Nulls: a null text is the empty one and has no tokens. Repeated rows are
counted one by one. Very long texts are worked off in slices cut between
pre-tokens. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import shipped, whole

SPACE = 0x2581  # stands for U+0020 inside pieces
SLICE_CHARS = 1 << 20
NONE = np.int32(2**31 - 1)
SAMPLES = ("", " ", "a  b\n c\td   ", "<s>hi</s>", "▁a\u0000x", "fi ﬁ ① café é", "aaaaaaaaa      bbbbbb", "\U0001f600​x　y")


class PairTable:
    """Open-addressing table from a pair of symbols to (rank, merged symbol), looked up for whole arrays."""

    def __init__(self, pairs: dict[int, tuple[int, int]]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.merged = np.full(1 << bits, -1, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        for key, at in zip(keys.tolist(), self.slot(keys).tolist(), strict=True):
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at] = key
            self.rank[at], self.merged[at] = pairs[key]

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.slot(keys)
        got = self.keys[at]
        open_ = np.flatnonzero((got != keys) & (got != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            got = self.keys[at[open_]]
            open_ = open_[(got != keys[open_]) & (got != -1)]
        hit = self.keys[at] == keys
        return np.where(hit, self.rank[at], NONE), np.where(hit, self.merged[at], -1)


class Segmenter:
    def __init__(self, model: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(library.get_piece_size())
        plain = [i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))]
        pieces = [library.id_to_piece(i) for i in plain]
        scores = [library.get_score(i) for i in plain]
        ranks = {s: r for r, s in enumerate(sorted(set(scores), reverse=True))}
        rank_of = {p: ranks[s] for p, s in zip(pieces, scores, strict=True)}
        symbols = list(dict.fromkeys(pieces + [c for p in pieces for c in p]))
        index = {s: i for i, s in enumerate(symbols)}
        self.n = len(symbols)
        pairs = {}
        for p in pieces:
            for k in range(1, len(p)):
                if p[:k] in index and p[k:] in index:
                    pairs[index[p[:k]] * self.n + index[p[k:]]] = (rank_of[p], index[p])
        self.table = PairTable(pairs)
        #: Symbol of a code point: its own, or -1 - (bytes in UTF-8) if it is in no piece.
        points = np.arange(0x110000)
        self.symbol = (-1 - (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))).astype(np.int32)
        for s, i in index.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i
        #: Tokens that a surviving symbol stands for.
        self.cost = np.array([1 if s in rank_of else len(s.encode()) for s in symbols], np.int64)
        #: Code points that are in no longer piece stand alone.
        alone = np.ones(0x110000, bool)
        for c in {ord(c) for p in pieces if len(p) > 1 for c in p}:
            alone[c] = False
        self.alone = alone
        if any(chr(SPACE) in p.lstrip(chr(SPACE)) for p in pieces):
            raise ValueError("pieces of this model reach across spaces")
        for text in SAMPLES:
            if self.count([text])[0] != len(library.encode(text)):
                raise ValueError(f"{model}: not a BPE model with byte fallback and identity normalisation")

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        batch, size = [], 0
        for i, text in enumerate(texts):
            for part in slices(chr(SPACE) + text) if text else ():
                batch.append((i, part))
                size += len(part)
                if size >= SLICE_CHARS:
                    self._add(out, batch)
                    batch, size = [], 0
        self._add(out, batch)
        return out

    def _add(self, out: np.ndarray, batch: list[tuple[int, str]]) -> None:
        if not batch:
            return
        points = np.frombuffer("".join(p for _, p in batch).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
        points[points == 0x20] = SPACE
        lengths = np.array([len(p) for _, p in batch])
        ends = np.cumsum(lengths)
        space, alone = points == SPACE, self.alone[points]
        start = np.empty(len(points), bool)
        start[0] = True
        start[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
        start[(ends - lengths)] = True
        starts = np.flatnonzero(start)
        sizes = np.diff(np.append(starts, len(points)))
        first, second = hashes(points, starts, sizes)
        _, one, same = np.unique(first, return_index=True, return_inverse=True)
        odd = np.flatnonzero(second[one][same] != second)  # two pre-tokens with one hash: count these by themselves
        counts = self.merge(points, starts[one], sizes[one])[same]
        if len(odd):
            counts[odd] = self.merge(points, starts[odd], sizes[odd])
        sums = np.concatenate([[0], np.cumsum(counts)])
        cut = np.searchsorted(starts, np.concatenate([[0], ends]))
        np.add.at(out, [i for i, _ in batch], sums[cut[1:]] - sums[cut[:-1]])

    def merge(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of each sequence points[start : start + size]."""
        owner = np.repeat(np.arange(len(starts)), sizes)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        symbol = self.symbol[points[starts[owner] + inside]]
        out = np.zeros(len(starts), np.int64)
        rank, merged = self._pairs(symbol, owner, np.arange(len(symbol)))
        while len(symbol):
            head = np.flatnonzero(np.diff(owner, prepend=-1))
            length = np.diff(np.append(head, len(owner)))
            best = np.repeat(np.minimum.reduceat(rank, head), length)
            if (ended := best == NONE).any():
                cost = np.where(symbol < 0, -1 - symbol, self.cost[symbol])
                out += np.bincount(owner[ended], cost[ended], len(out)).astype(np.int64)
                go = ~ended
                symbol, owner, rank, merged, best = symbol[go], owner[go], rank[go], merged[go], best[go]
                if not len(symbol):
                    break
            take = self._chosen(np.flatnonzero(rank == best), symbol, owner, rank, merged)
            symbol[take] = merged[take]
            stay = np.ones(len(symbol), bool)
            stay[take + 1] = False
            place = np.cumsum(stay) - 1
            touched = place[take]
            touched = np.unique(np.concatenate([touched, touched[touched > 0] - 1]))
            symbol, owner, rank, merged = symbol[stay], owner[stay], rank[stay], merged[stay]
            rank[touched], merged[touched] = self._pairs(symbol, owner, touched)
        return out

    def _pairs(self, symbol: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of the pairs that begin at the positions ``at``."""
        rank, merged = np.full(len(at), NONE, np.int32), np.full(len(at), -1, np.int32)
        in_range = np.flatnonzero(at + 1 < len(symbol))
        left = at[in_range]
        good = in_range[(owner[left] == owner[left + 1]) & (symbol[left] >= 0) & (symbol[left + 1] >= 0)]
        left = at[good]
        rank[good], merged[good] = self.table.find(symbol[left].astype(np.int64) * self.n + symbol[left + 1])
        return rank, merged

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        found = np.full(len(left), NONE, np.int32)
        good = np.flatnonzero((left >= 0) & (right >= 0))
        found[good] = self.table.find(left[good].astype(np.int64) * self.n + right[good])[0]
        return found

    def _chosen(self, hit: np.ndarray, symbol: np.ndarray, owner: np.ndarray, rank: np.ndarray, merged: np.ndarray) -> np.ndarray:
        """Of the lowest-ranked pairs, those that one-by-one merging from the left would merge as well.

        Overlapping ones alternate. If a pair that a merge creates ranks no
        higher than the merge, it would come first; that sequence then merges
        its leftmost pair only.
        """
        run = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
        offset = np.arange(len(hit)) - np.repeat(run, np.diff(np.append(run, len(hit))))
        take = hit[offset % 2 == 0]
        after = symbol.copy()
        after[take] = merged[take]
        own = np.append(owner, -1)
        wide = np.append(symbol, np.int32(-1))
        post = np.append(after, np.int32(-1))
        right = np.minimum(take + 2, len(symbol))
        same = own[right] == owner[take]
        new = merged[take]
        low = np.minimum(self._rank(new, wide[right]), self._rank(new, post[right]))
        risky = same & (low <= rank[take])
        chosen = np.zeros(len(symbol), bool)
        chosen[take] = True
        back = np.where((take > 1) & chosen[np.maximum(take - 2, 0)], take - 2, take - 1)
        same = (back >= 0) & (owner[np.maximum(back, 0)] == owner[take])
        risky |= same & (self._rank(after[np.maximum(back, 0)], new) <= rank[take])
        if not risky.any():
            return take
        firsts = np.append(True, owner[take][1:] != owner[take][:-1])
        return take[firsts | ~np.isin(owner[take], owner[take[risky]])]


def slices(text: str) -> Iterator[str]:
    """The text in slices of about SLICE_CHARS that end before a space after another character."""
    at = 0
    while len(text) - at > SLICE_CHARS:
        cut = at + SLICE_CHARS
        while 0 < (cut := text.find(" ", cut)) and text[cut - 1] in (" ", chr(SPACE)):
            cut += 1
        if cut < 0:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def hashes(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each sequence."""
    place = (np.arange(len(points)) - np.repeat(starts, sizes)).astype(np.uint64)
    out = []
    for a, b in ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)):
        x = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(a) + place * np.uint64(b)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        out.append(np.add.reduceat(x, starts))
    return out[0], out[1]


@lru_cache(maxsize=2)
def segmenter(model: str) -> Segmenter:
    return Segmenter(model)


def count_tokens(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes and n_tokens of each row; one pass over the texts, no shuffle."""
    shipped(docs.sparkSession)
    own = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n_bytes = pa.array([len(t.encode()) for t in texts], pa.int64())
            n_tokens = pa.array(segmenter(model).count(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(counted, f"doc_id {kind}, n_bytes long, n_tokens long")
