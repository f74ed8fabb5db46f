"""Phrase collocations against their definition."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from brute import LOWER

from creditlake.llm import collocations

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mined(rows, least, top=2000, longest=5):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, min(longest, len(w) - i) + 1):
                    f[(lang, *w[i : i + k])] += 1
    found = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = {(p[0], *p[i : i + k]) for p, a in found.items() for k in range(2, len(p) - 1) for i in range(1, len(p) - k + 1) if a >= f[(p[0], *p[i : i + k])]}
    out = defaultdict(list)
    for p, a in found.items():
        if p in inside:
            continue
        lang, parts = p[0], [(f[p[: k + 1]], f[(p[0], *p[k + 1 :])]) for k in range(1, len(p) - 1)]
        score, _, (left, right) = min((1000 * a * n[lang] // (x * y), k, (x, y)) for k, (x, y) in enumerate(parts))
        out[lang].append((-score, -a, " ".join(p[1:]).encode(), left, right))
    return [(g, i + 1, t.decode(), -a, x, y, n[g], -s) for g, v in out.items() for i, (s, a, t, x, y) in enumerate(sorted(v)[:top])]


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("longest, top, bits", [(5, 2000, None), (5, 7, 16), (2, 2000, None), (3, 2000, 16)])
def test_mined_phrases(spark, longest, top, bits):
    rng = random.Random(longest)
    vocabulary = [f"w{k}" for k in range(12)] + ["É", "ß", "the", "THE", "x" * 300]
    rows = []
    for _ in range(150):
        words = rng.choices(vocabulary, weights=range(17, 0, -1), k=rng.randint(0, 60))
        rows.append((rng.choice(["en", "de", None, "und", ""]), "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for w in words)))
    rows += [("en", None), (None, ""), ("en", " ;; \n"), ("fr", "the same the same the same " * 40), ("en", rows[0][1])]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = rows_of(collocations.collocations(docs, least=8, longest=longest, top=top, bits=bits))
    assert got == sorted(mined(rows, 8, top, longest)) and got


def test_scores_are_exact_beyond_64_bits(spark):
    big = 4_000_000_000_003
    counts = [("en", [], 9 * big), ("en", ["a"], big), ("en", ["b"], big - 1), ("en", ["a", "b"], big - 2)]
    out = collocations.scored(spark.createDataFrame(counts, "lang string, words array<string>, f long")).collect()
    assert [(r["a"], r["score"]) for r in out] == [(big - 2, 1000 * (big - 2) * 9 * big // (big * (big - 1)))]


def test_empty_and_clashing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).columns == list(COLUMNS)
    assert collocations.collocations(docs).count() == 0
    clash = spark.createDataFrame([("en", "a b " * 30, 1, "x")], "lang string, text string, n int, words string")
    assert rows_of(collocations.collocations(clash, least=5)) == sorted(mined([("en", "a b " * 30)], 5))


@pytest.mark.parametrize("most", [collocations.MOST_HELD, 40])
def test_windows_of_a_task_are_combined(spark, most):
    """A task gives a window once however many batches it reads, or starts anew where it holds too many."""
    rows = [("en" if k % 3 else "de", " ".join(f"w{(k * j) % 7}" for j in range(30)) + f". rare{k} w1") for k in range(200)]
    own = collocations.shipped(spark).createDataFrame(rows, "lang string, text string").coalesce(1)
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, "5")
    try:
        made = collocations.windows(own, collocations.frequent(own, 16, 50), most=most).collect()
    finally:
        spark.conf.set(key, before)
    n, distinct = Counter(), Counter(tuple(r)[:-1] for r in made)
    for r in made:
        n[r["lang"]] += r["n"]
    assert n == {g: 32 * sum(lang == g for lang, _ in rows) for g in ("en", "de")}
    assert (max(distinct.values()) == 1) == (most > 40)


def test_small_splits_are_counted_together(spark):
    """Many small splits of a table are counted in as many tasks as the session runs, or its text asks for."""
    tasks = spark.sparkContext.defaultParallelism
    rows = [("en", "to be or not to be " * 3)] * 400
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(8 * tasks)
    made = []
    kept = collocations.materialize
    collocations.materialize = lambda df, label: made.append(kept(df, label)) or made[-1]
    try:
        got = rows_of(collocations.collocations(docs))
    finally:
        collocations.materialize = kept
    assert got == sorted(mined(rows, collocations.LEAST)) and got
    assert made[0].count() <= tasks * made[0].drop("n").distinct().count()
