"""Byte and word dedup against brute force, with the rows that tend to break such code."""

from __future__ import annotations

import random

import pytest
from brute import byte_dedup, sha, word_dedup
from pyspark.sql import functions as F

from creditlake.llm import bwt_dedup, grams, seed_extend
from creditlake.llm.common import text_bytes

DDL = "doc_id long, text string, part int, bucket string, `__kept_` string, n_chars long"


def corpus(seed: int, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["a", "bb", "cé", "d-d", "漢字", "x y", "0"] + ["".join(rng.choice("aeinrst") for _ in range(rng.randint(1, 8))) for _ in range(60)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 70))] for _ in range(6)]
    rows = []
    for i in range(n):
        out: list[str] = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            cut = rng.randrange(len(p)) if rng.random() < 0.5 else 0
            out += p[cut:] if rng.random() < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        rows.append((i * 3, rng.choice([" ", "\n", "\t ", "  "]).join(out)))
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "word"), (None, " ".join(passages[0] * 2)), (None, "a b"), (7, " ".join(passages[1]))]
    rows += [rows[5], rows[5], (504, "z " * 3000), (505, "z" * 5000), (506, "z" * 200)]
    rng.shuffle(rows)
    return [(i, t, 1, "b", "k", len(t) if t else None) for i, t in rows]


def with_low_ids(rows):
    return [(-(1 << 63) if r[0] is None else r[0], r[1]) for r in rows]


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_words_match_brute_force(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DDL).repartition(3)
    got = seed_extend.remove_repeats(docs, length=10, gram=4)
    assert [c for c in got.columns if not c.startswith("__n") and c != "__kept"] == [c for c in docs.columns if c != "text"]
    found = [(r["doc_id"], r["__n_words"], r["__n_removed"], r["__kept"]) for r in got.collect()]
    want = [(None if i == -(1 << 63) else i, *x) for i, *x in word_dedup(with_low_ids(rows), 10)]
    assert ordered(found) == ordered(want)
    assert sum(x[2] > 0 for x in found) > 10


@pytest.mark.parametrize(("seed", "hot"), [(1, 20_000), (3, 0)])
def test_bytes_match_brute_force(spark, seed, hot):
    """hot = 0: every shared anchor is dealt out string by string."""
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DDL).repartition(3)
    got = bwt_dedup.remove_repeats(docs, hot=hot)
    found = [(r["doc_id"], r["__n_bytes"], r["__n_removed"], r["__n_spans"], sha(bytes(r["__kept"]))) for r in got.collect()]
    want = [(None if i == -(1 << 63) else i, *x) for i, *x in byte_dedup(with_low_ids(rows))]
    assert ordered(found) == ordered(want)
    assert sum(x[2] > 0 for x in found) > 10


def test_small_blocks_and_parts_do_not_matter(spark, monkeypatch):
    rows = corpus(4)
    docs = spark.createDataFrame(rows, DDL)
    whole = ordered(tuple(r) for r in bwt_dedup.remove_repeats(docs).select("doc_id", "__n_removed", "__kept").collect())
    monkeypatch.setattr(bwt_dedup, "BLOCK_BYTES", 300)
    monkeypatch.setattr(bwt_dedup, "BATCH_BYTES", 500)
    assert text_bytes(docs) > 10_000
    assert ordered(tuple(r) for r in bwt_dedup.remove_repeats(docs).select("doc_id", "__n_removed", "__kept").collect()) == whole


def test_stage_keeps_columns_and_untouched_texts(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{passage}\n  tail", 1, "b", "k", 7), (2, f"head  {passage}", 1, "b", "k", 8), (3, " plain \n text ", 2, "c", None, 15), (4, None, 1, "b", "k", None)]
    out = seed_extend.without_repeats(spark.createDataFrame(rows, DDL))
    assert out.columns == ["doc_id", "text", "part", "bucket", "__kept_", "n_chars"]
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert found == {1: (f"{passage}\n  tail", 7), 2: ("head", 4), 3: (" plain \n text ", 15), 4: (None, None)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DDL)
    assert bwt_dedup.remove_repeats(none).count() == 0
    assert seed_extend.remove_repeats(none).count() == 0
    assert seed_extend.without_repeats(none).columns == none.columns


def test_copies_cost_no_quadratic_work(spark):
    """A thousand copies: every one after the first goes, as one entry a part."""
    text = " ".join(f"v{i * i}" for i in range(80))
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    out = seed_extend.remove_repeats(docs).groupBy("__n_removed").count().collect()
    assert sorted((r["__n_removed"], r["count"]) for r in out) == [(0, 1), (80, 999)]


def test_windows_share_their_anchor_wherever_they_stand():
    import pyarrow as pa

    rng = random.Random(0)
    window = bytes(rng.randrange(97, 101) for _ in range(50)).decode()
    seen = set()
    for _ in range(30):
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) + window + "".join(rng.choice("abcd") for _ in range(20))
        units = grams.byte_units(grams.Texts.of(pa.array([text])))
        runs = grams.winnowed(units, 50, 20)
        at = text.index(window)
        seen.add(next((int(a - at), int(h)) for f, last, a, h in zip(*runs, strict=True) if f <= at <= last))
    assert len(seen) == 1


def test_stretch_names_follow_the_bytes_and_need_little_memory():
    """Equal stretches have one name wherever they begin; naming all, which overlap, holds a few arrays of the text's size."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    text = "".join(rng.choice("abcd ") for _ in range(40_000))
    units = grams.byte_units(grams.Texts.of(pa.array([text, "shift" + text, "é" * 60 + "è" + "é" * 60])))
    runs = grams.winnowed(units, 50, 16)
    sizes = runs.last - runs.first + 50
    tracemalloc.start()
    names = bwt_dedup.stretch_hash(units, runs.first, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 80 * len(units.hashes)
    data = grams.Texts.of(pa.array([text, "shift" + text, "é" * 60 + "è" + "é" * 60])).data
    stretches = [data[f : f + n].tobytes() for f, n in zip(runs.first, sizes, strict=True)]
    assert len(set(stretches)) < len(stretches)
    assert len(set(zip(stretches, names.tolist(), strict=True))) == len(set(stretches)) == len(np.unique(names))
