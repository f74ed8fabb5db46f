"""Crowded regions of the LSH forest: every pair at the threshold is found, in bounded pieces."""

from __future__ import annotations

import random

import pytest
from brute import near_dedup as brute_near
from brute import shingles
from pyspark.sql import functions as F

from creditlake.llm import near_dedup

DDL = "doc_id long, text string"


def templates(rng, groups, planted, common=170, own=40):
    """Documents that share ``common`` words and have ``own`` more; two of a planted pair share some of these as well."""
    head = [f"t{k}" for k in range(common)]
    rows = []
    for i in range(groups):
        tail = [f"d{i}w{k}" for k in range(own)]
        rows.append((2 * i, " ".join(head + tail)))
        if i < planted:
            rows.append((2 * i + 1, " ".join(head + tail[:12] + [f"e{i}w{k}" for k in range(own - 12)])))
    rng.shuffle(rows)
    return rows


def likeness(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("split", [near_dedup.SPLIT, 64])
def test_planted_pairs_in_a_template_group(spark, monkeypatch, split):
    """Thousands of classes at 0.70 to each other, pairs just above the threshold between them."""
    monkeypatch.setattr(near_dedup.forest_pairs, "__defaults__", (split,))
    rows = templates(random.Random(5), 2000, 100)
    of = {i: shingles(t) for i, t in rows}
    assert likeness(of[0], of[2]) < 0.70 < 0.75 < likeness(of[0], of[1]) < 0.77
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_components(spark.createDataFrame(rows, DDL).repartition(4)).collect()}
    assert found == {i: i - i % 2 for i, _ in rows}


def test_common_shingles_only(spark):
    """Pairs without a rare shingle: texts dealt from a few common paragraphs, held against brute force."""
    rng = random.Random(9)
    parts = [[f"p{k}w{j}" for j in range(12)] for k in range(14)]
    rows = []
    for i in range(250):
        rows.append((i, " ".join(w for k in sorted(rng.sample(range(14), rng.randint(7, 9))) for w in parts[k])))
    docs = spark.createDataFrame(rows, DDL)
    classes = {shingles(t): i for i, t in reversed(rows)}
    texts = dict(rows)
    crowd = spark.createDataFrame([(i, len(c), i) for c, i in classes.items()], "cls long, n int, label long")
    own = spark.createDataFrame([(i, texts[i]) for i in classes.values()], DDL)
    signed = near_dedup.signed_rows(own, "doc_id", "text").select(F.col("id").alias("label"), "cls", "n")
    crowd = crowd.select("label").join(signed, "label")
    with_text = signed.join(own, F.col("label") == F.col("doc_id")).select("cls", "text")
    names = {r["cls"]: r["label"] for r in signed.collect()}
    links = {tuple(sorted((names[r["a"]], names[r["b"]]))) for r in near_dedup.crowd_links(crowd, with_text, 2).collect()}
    ids = sorted(classes.values())
    sets_of = {i: c for c, i in classes.items()}
    assert links == {(a, b) for a in ids for b in ids if a < b and likeness(sets_of[a], sets_of[b]) >= 0.75}
    found = sorted(tuple(r) for r in near_dedup.near_components(docs).collect())
    assert found == sorted(brute_near(rows))


def test_no_task_holds_a_region(spark):
    """Pieces stay within ``split`` rows and the neighbours carried over."""
    rows = templates(random.Random(6), 600, 0)
    plain = near_dedup.signed_rows(spark.createDataFrame(rows, DDL), "doc_id", "text")
    members = plain.select(F.lit(1).cast("long").alias("key"), F.lit(0).alias("tree"), "cls", F.col("id").alias("rep"), "n", "sig", F.lit(600).cast("long").alias("size"))
    found, again = near_dedup.region_pairs(members, 50)
    neighbours = found.select("a").union(found.select("b")).distinct().count()
    assert neighbours == 600
    # Two leads a piece and the outer rows of each task come again, not the region.
    assert 0 < again.count() < 300


def test_rows_without_id_connect_nothing(spark):
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (None, "q r s t u v"), (9, "q r s t u v")]
    docs = spark.createDataFrame(rows, DDL)
    found = {r["doc_id"]: r["component_id"] for r in near_dedup.near_components(docs).where("doc_id is not null").collect()}
    assert found == {5: 5, 9: 9}
