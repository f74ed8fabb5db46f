"""Array work on batches of texts: units (bytes or words), gram hashes, winnowed anchors.

All texts of a batch lie in one array; what would cross from one text into the
next is masked. Everything derived from a window depends on its content only,
so equal windows of different documents get equal anchors.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
PLACE_BITS = U(26)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
_random = np.random.default_rng(20_240_601)
BYTE_HASH = _random.integers(0, 2**64, 256, dtype=U)
PLACED_HASH = _random.integers(0, 2**64, (64, 256), dtype=U).ravel()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Texts(NamedTuple):
    """Texts one after the other: their bytes, and where each begins (one entry more than texts)."""

    data: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray) -> Texts:
        """The strings of an Arrow column; null is the empty text."""
        column = column.cast(pa.large_string())
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
        column = column.fill_null("")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        return cls(whole[at[0] : at[-1]], at - at[0])

    def __len__(self) -> int:
        return len(self.begins) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.begins[i] : self.begins[i + 1]].tobytes()


def batches(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` in sum, at least one row each."""
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield at, to
        at = to


class Grams(NamedTuple):
    """Units of a batch of texts: a hash each, the text each belongs to, and (for words) its bytes."""

    hashes: np.ndarray
    owner: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


def byte_units(texts: Texts) -> Grams:
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(texts.begins))
    at = np.arange(len(texts.data))
    return Grams(BYTE_HASH[texts.data], owner, at, at + 1)


def word_units(texts: Texts, lower: bool = False) -> Grams:
    """Words ``[^\\x20\\x09-\\x0D]+``; with ``lower``, hashed as if A-Z were a-z."""
    data, begins = texts.data, texts.begins
    blank = BLANK[data]
    first = np.zeros(len(data) + 1, bool)
    first[begins] = True
    prior = np.append(True, blank[:-1]) if len(data) else blank
    starts = np.flatnonzero(~blank & (prior | first[:-1]))
    after = np.append(blank[1:], True) if len(data) else blank
    ends = np.flatnonzero(~blank & (after | first[1:])) + 1
    letters = np.flatnonzero(~blank)
    lengths = ends - starts
    heads = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(heads, lengths)
    own = data[letters]
    value = PLACED_HASH[((place & 63) << 8) + (LOWER[own] if lower else own)]
    if len(place) and place.max() > 63:
        value = value * (U(2) * (place >> 6).astype(U) + U(1))
    hashes = mixed(np.add.reduceat(value, heads) + lengths.astype(U)) if len(starts) else np.zeros(0, U)
    owner = (np.searchsorted(begins, starts, "right") - 1).astype(np.int32)
    return Grams(hashes, owner, starts, ends)


def chained(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` units, by doubling; one entry for each position where a run begins."""
    done, parts, level, size = 0, None, hashes, 1
    while True:
        if length & size:
            if parts is None:
                parts, done = level, size
            else:
                n = max(0, len(hashes) - done - size + 1)
                parts = joined(parts[:n], level[done : done + n])
                done += size
        if size * 2 > length:
            return parts if length > 1 else hashes
        n = max(0, len(level) - size)
        level = joined(level[:n], level[size : size + n])
        size *= 2


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    x = left * U(0x9E3779B97F4A7C15) + right
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


class Runs(NamedTuple):
    """Windows of a batch, grouped: windows first..last have the anchor ``hash`` at the unit ``anchor``."""

    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    hash: np.ndarray


def winnowed(grams: Grams, length: int, gram: int) -> Runs:
    """The anchor of a window of ``length`` units: its least gram of ``gram`` units, the leftmost of equal ones."""
    none = np.zeros(0, np.int64)
    n = len(grams.hashes) - length + 1
    if n < 1:
        return Runs(none, none, none, none.astype(U))
    hashes = chained(grams.hashes, gram)
    low = (U(1) << PLACE_BITS) - U(1)
    at = np.arange(len(hashes), dtype=U) & low
    found = least((hashes & ~low) | at, length - gram + 1)
    valid = grams.owner[:n] == grams.owner[length - 1 :]
    windows = np.flatnonzero(valid)
    if not len(windows):
        return Runs(none, none, none, none.astype(U))
    place = (found[windows] & low).astype(np.int64)
    place += windows & ~np.int64(low)  # the place is known up to multiples of 2^26
    place += np.where(place < windows, np.int64(low) + 1, 0)
    new = np.append(True, (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1))
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(windows)) - 1
    return Runs(windows[head], windows[tail], place[head], hashes[place[head]])


def spans(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... for ``sizes[0]`` entries, then first[1], and so on."""
    heads = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(first - heads, sizes)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` units lie in a window of ``length`` that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + length, n), -1)
    return np.cumsum(edge[:-1]) > 0
