"""The conversation prefix trie against its definition, its parentheses against a stack."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from brute import words
from pyspark.sql import functions as F

from creditlake.llm import prefix_trie

DDL = "conv_id long, turn long, role string, text string, path string, key int"
NODES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nodes(rows, heads=lambda c: 0, base=lambda c: c):
    """Every node by its definition."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in by.items()}
    paths = {c: own.get(base(c), [])[: heads(c)] + v[heads(c) :] for c, v in own.items()}
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(paths):
        p = tuple(paths[c])
        for k in range(len(p) + 1):
            members[p[:k]].append(c)
            if k:
                children[p[: k - 1]].add(p[:k])
        ends[p].append(c)
    out, leaves, saved = [], {}, {}
    for q in sorted(members, key=len, reverse=True):
        leaves[q] = sum(leaves[x] for x in children[q]) or 1
        saved[q] = sum(saved[x] for x in children[q]) + ((len(members[q]) - 1) * len(words(q[-1][1])) if q else 0)
        digest = hashlib.sha256(",".join(map(str, ends[q])).encode()).hexdigest()
        out.append((members[q][0], len(q), members[q[:-1]][0] if q else None, len(members[q]), len(children[q]), leaves[q], saved[q], digest))
    return sorted(out, key=repr)


def found(spark, rows, parts, fan, heads=None, base=None):
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(2)
    c = F.col("conv_id")
    made = prefix_trie.rebuilt(turns, F.lit(0) if heads is None else heads(c), c if base is None else base(c))
    saved = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        return sorted((tuple(r[n] for n in NODES) for r in prefix_trie.nodes(made, fan=fan).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", saved)


@pytest.mark.parametrize("parts, fan", [(1, 32), (7, 2), (20, 3)])
def test_nodes(spark, parts, fan):
    rng = random.Random(parts)
    rows = []
    for c in range(90):
        for turn in range(rng.choice([0, 1, 2, 3, 3, 4, 6])):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "a b", "", None, "c d e"])))
    rows += [(200 + c, turn, "user", "same old words") for c in range(60) for turn in range(2)]  # a hot conversation
    rows += [(500, turn, "user", "deep") for turn in range(150)] + [(501, turn, "user", "deep") for turn in range(149)]
    rows += [rows[0], (None, 1, "user", "nobody"), (None, None, None, None)]
    assert found(spark, rows, parts, fan) == nodes(rows)
    heads, base = (lambda c: c % 4), (lambda c: c - c % 20)
    assert found(spark, rows, parts, fan, lambda c: (c % 4).cast("int"), lambda c: c - c % 20) == nodes(rows, heads, base)


def test_empty(spark):
    assert found(spark, [], 3, 2) == []


@pytest.mark.parametrize("n", [1, 50, 3000, 20000])
def test_find_close(n):
    rng = random.Random(n)
    opens, depth = [True], 1
    left = n - 1
    while left or depth > 1:
        up = left and (depth == 1 or rng.random() < rng.choice([0.5, 0.9]))
        opens.append(bool(up))
        depth += 1 if up else -1
        left -= bool(up)
    opens.append(False)
    stack, want = [], {}
    for i, o in enumerate(opens):
        if o:
            stack.append(i)
        else:
            want[stack.pop()] = i
    opens = np.array(opens)
    places = np.flatnonzero(opens)
    assert prefix_trie.Parens(opens).find_close(places).tolist() == [want[p] for p in places.tolist()]
