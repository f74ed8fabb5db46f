"""Plain versions of the operators, by their definitions, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def gone(rows, units, length):
    """Per row (id, text): units, and which lie in a window that a row with a smaller id has too."""
    split = [(i, units(t)) for i, t in rows]
    first = {}
    for i, x in split:
        for k in range(len(x) - length + 1):
            key = tuple(x[k : k + length])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, x in split:
        mask = [False] * len(x)
        for k in range(len(x) - length + 1):
            if first[tuple(x[k : k + length])] < i:
                mask[k : k + length] = [True] * length
        out.append((x, mask))
    return out


def byte_dedup(rows, length=50):
    out = []
    for (i, _), (x, mask) in zip(rows, gone(rows, lambda t: (t or "").encode(), length), strict=True):
        opens = sum(m and not (k and mask[k - 1]) for k, m in enumerate(mask))
        out.append((i, len(x), sum(mask), opens, sha(bytes(b for b, m in zip(x, mask, strict=True) if not m))))
    return out


def word_dedup(rows, length=50):
    out = []
    for (i, _), (x, mask) in zip(rows, gone(rows, words, length), strict=True):
        out.append((i, len(x), sum(mask), " ".join(w for w, m in zip(x, mask, strict=True) if not m)))
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def near_dedup(rows, percent=75):
    """(id, set size, component) of each row; rows with one id are one document."""
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            having[g].append(k)
    for k, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for other in having[g]:
                if other < k:
                    common[other] += 1
        for other, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[other]) - c):
                a, b = sorted((root(rows[k][0]), root(rows[other][0])))
                parent[b] = a
    return [(i, len(s), root(i)) for (i, _), s in zip(rows, sets, strict=True)]


def base_counts(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = defaultdict(list)
    for k in range(len(w) - 4):
        grams[tuple(w[k : k + 5])].append(k)
    covered = {k + j for at in grams.values() if len(at) > 1 for k in at for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Target of each source of {source: size}; null last."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, closed = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in order if s not in closed]
        if not rest:
            return {s: float(most * sizes[s]) for s in order}
        level = (total - sum(most * sizes[s] for s in closed)) / sum(weight[s] for s in rest)
        more = {s for s in rest if most * sizes[s] <= level * weight[s]}
        if not more:
            return {s: min(float(most * sizes[s]), level * weight[s]) for s in order}
        closed |= more


def copies(doc_id, rate, seed="mix-1"):
    digest = hashlib.md5(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    return int(rate) + (int(digest[:13], 16) / 2**52 < rate - int(rate))
