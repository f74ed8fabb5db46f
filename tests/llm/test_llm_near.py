"""Near-duplicate components against brute force."""

from __future__ import annotations

import random

import pytest
from brute import near_dedup as brute_near
from pyspark.sql import functions as F

from creditlake.llm import near_dedup
from creditlake.llm.components import components

DDL = "doc_id long, text string, cls string, id int"


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return out


def corpus(seed):
    rng = random.Random(seed)
    rows, i = [], 0
    for _ in range(12):
        base = [f"b{rng.randrange(3000)}" for _ in range(rng.choice([3, 4, 6, 40, 150]))]
        for _ in range(rng.randint(1, 6)):
            words = edited(rng, base, rng.choice([0, 0, 1, 2, 5]))
            if rng.random() < 0.3:
                words = [w.upper() for w in words]
            rows.append((i, rng.choice([" ", "\n"]).join(words)))
            i += 1
    centre = [f"c{k}" for k in range(200)]
    rows += [(1000 + k, " ".join(edited(rng, centre, 5))) for k in range(150)] + [(1500, " ".join(centre))]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, " ".join(centre[:100])), (2006, rows[0][1])]
    rows += [rows[3], (2007, "y " * 4000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "split"), [(1, None), (2, 8)])
def test_components_match_brute_force(spark, monkeypatch, seed, split):
    if split:  # regions above ``split`` are cut by further values
        monkeypatch.setattr(near_dedup.forest_pairs, "__defaults__", (split,))
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(3)
    found = sorted(tuple(r) for r in near_dedup.near_components(docs).collect())
    assert found == sorted(brute_near(rows))
    assert any(i != c for i, _, c in found)


def test_rows_without_id_and_empty_tables(spark):
    rows = [(None, "a b c d e f", "x", 1), (5, "a b c d e f", "x", 1), (None, "q r s t u v", "x", 1)]
    found = sorted(((r[0], r[1], r[2]) for r in near_dedup.near_components(spark.createDataFrame(rows, DDL)).collect()), key=repr)
    assert found == [(5, 2, 5), (None, 2, 5), (None, 2, None)]
    none = spark.createDataFrame([], DDL)
    assert near_dedup.near_components(none).count() == 0
    assert near_dedup.keep_one(none).columns == none.columns


def test_stage_keeps_the_smallest(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(3, text, "x", 1), (1, text + " more", "y", 2), (9, "other words entirely here now", None, 3), (None, "alone", "z", 4)]
    out = near_dedup.keep_one(spark.createDataFrame(rows, DDL))
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted([rows[1], rows[2], rows[3]], key=repr)


def test_chains_and_stars_are_joined(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 400)] + [(7, 7), (500, 501)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long"), len(edges)).collect()}
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 400)}, 500: 500, 501: 500}
    assert components(spark.createDataFrame([], "a long, b long"), 0).count() == 0


def test_candidates_grow_with_the_rows_only(spark):
    """Equal sets make one class, so copies make no pairs at all."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b c d e f g h").alias("text"))
    assert near_dedup.near_components(docs).where("component_id <> 0").count() == 0


def test_texts_travel_once_a_class(spark, monkeypatch):
    """Rows without an id and repeated rows do not multiply the pairs of texts that are compared."""
    compared, confirm = [], near_dedup.confirm

    def counted(pairs, texts):
        assert texts.groupBy("cls").count().where("count > 1").isEmpty()
        compared.append((pairs.count(), texts.count()))
        return confirm(pairs, texts)

    monkeypatch.setattr(near_dedup, "confirm", counted)
    base = [f"w{k}" for k in range(60)]
    near = [" ".join([*base, f"x{k}"]) for k in range(40)]
    for rows in ([(k, t) for k, t in enumerate(near)], [(None, t) for t in near] * 2, [(1, near[0]), (2, near[1])] * 300):
        compared.clear()
        found = near_dedup.near_components(spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(4)).collect()
        assert len(found) == len(rows) and len({r["component_id"] for r in found}) == 1
        assert all(n <= len(set(near)) for _, n in compared) and sum(p for p, _ in compared) < 40 * 40


def test_one_of_the_copies_without_an_id_stays(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(None, text, "x", 1), (None, text, "y", 2), (None, text + " more", "z", 3), (None, "", "e", 4), (None, None, "n", 5), (None, "q r s t u v", "q", 6)]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, DDL)).collect()
    texts = [r[1] for r in kept]
    assert sum((t or "").startswith("w0") for t in texts) == 1 and "q r s t u v" in texts and len(kept) == 3
    clash = spark.createDataFrame([(1, text, "a", 1), (2, text, "b", 2)], "doc_id long, text string, __id string, row int")
    assert [tuple(r) for r in near_dedup.keep_one(clash).collect()] == [(1, text, "a", 1)]
