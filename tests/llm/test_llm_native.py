"""Mixing, quality rules, chat formatting, fingerprints and revisits on hand-made rows."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
import xxhash
from brute import base_counts, copies, sha, targets, words
from pyspark.sql import functions as F

from creditlake.llm import chat, common, fingerprints, mixing, quality, warc

DOCS = "doc_id long, text string, lang string, source string, size string, kept int, `__x` int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "s", 1, 2) for i, t, lang, s in rows], DOCS).repartition(3)


# ---- mixing


def mix_rows(seed):
    rng = random.Random(seed)
    sources = ["a", "b", "c", "d", "e", "\U0001f600", "é", "Z", None, ""]
    rows = [(i, " ".join("w" * rng.randint(0, 30)), "en", rng.choice(sources)) for i in range(200)]
    rows += [(1000 + i, "x " * 5, "en", "hot") for i in range(150)] + [(7, "one two", "en", "a")] * 3
    return rows + [(None, "n o id", "en", "b"), (2000, None, "en", "only empty"), (2001, "", "en", "only empty")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_mix_matches_brute_force(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows = mix_rows(1)
    docs = docs_of(spark, rows)
    size = defaultdict(int)
    for _, t, _, s in rows:
        size[s] += len(words(t))
    want = targets(size)
    rate = {s: want[s] / size[s] if size[s] else 0.0 for s in size}
    expected = Counter()
    for i, t, lang, s in rows:
        expected[(i, t, lang, s, "s", 1, 2)] += copies(i, rate[s])
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(tuple(r) for r in mixed.collect()) == +expected
    sizes = docs.select("source", mixing.size_of(F.col("text")).alias("size"))
    found = {r["source"]: (r["source_size"], r["target"]) for r in mixing.source_targets(sizes).collect()}
    assert found == {s: (size[s], want[s]) for s in size}


def test_taken_words_come_near_the_targets(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.pmod("id", F.lit(3))).alias("source"), F.lit(10).alias("size"))
    targets_ = mixing.source_targets(docs)
    taken = mixing.copies(docs, targets_).groupBy("source").agg(F.sum(F.col("__mix.copies") * 10), F.first("__mix.target")).collect()
    assert all(abs(t - target) < 0.02 * target for _, t, target in taken)
    assert sum(target for _, _, target in taken) == pytest.approx(450_000)


def test_mix_of_nothing(spark):
    none = docs_of(spark, [])
    assert mixing.mix(none).columns == none.columns
    assert mixing.mix(none).count() == 0
    assert mixing.mix(docs_of(spark, [(1, None, None, None)])).count() == 0


# ---- quality rules


def text_rows():
    rng = random.Random(4)
    rows = [None, "", " \n\t\x0b", "one", "a b c d e a b c d e f g", "x " * 400, "\n".join(["same line here", "other"] * 6), "#*$%&|<> " * 12, "é漢 \U0001f600 ok!"]
    for _ in range(60):
        rows.append(rng.choice([" ", "\n"]).join(rng.choice(["a", "b", "c d", "e#", "F", "g!"]) for _ in range(rng.randint(0, 60))))
    return [*rows, "a b c d e " * 3000, rows[4]]


def test_counts_match_brute_force(spark):
    rows = [(i, t, "en", None) for i, t in enumerate(text_rows())]
    found = {r["doc_id"]: tuple(r["__f"])[:5] for r in quality.features(docs_of(spark, rows)).collect()}
    assert found == {i: base_counts(t) for i, t, *_ in rows}


def binomial_below(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log(1 - p)) for j in range(k + 1))


def test_the_binomial_test_is_exact(spark):
    cases = [(k, n) for n in (0, 1, 50, 700, 5000, 200_000) for k in (0, 1, 3, 20, 700) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality.passes(F.col("k"), F.col("n"), 0.005, F.lit(0.001)).alias("ok"))
    for k, n, ok in df.collect():
        assert ok == (k < 0.005 * n and binomial_below(k, n, 0.005) <= 0.001), (k, n)


def labelled(spark, n=12_000):
    """Clean documents with few symbols, some of them shouting, and bad ones full of symbols."""
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        w = [f"{rng.choice('abcdefghij')}{rng.randrange(10**6)}" for _ in range(20)]
        bad, lang = i % 10 == 0, "en" if i % 3 else None
        if bad:
            w = [x + "###" for x in w]
        elif lang == "en" and i % 7 == 1:
            w = [x + "!" for x in w]
        rows.append((i, " ".join(w), lang, "s"))
        if i % 2 == 0:
            labels += [(i, 0 if bad else 1, 0, "x")] * (1 + i % 4)
    return rows, labels + [(None, 1, 0, "x"), (3, None, 0, "x"), (10**9, 1, 1, "x")]


def test_thresholds_spare_good_documents_and_catch_bad_ones(spark):
    rows, labels = labelled(spark)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, lang string")
    docs = docs_of(spark, rows)
    limits = {r["stratum"]: r.asDict() for r in quality.calibrate(quality.scores(docs), marks).collect()}
    assert set(limits) == {"en", None}
    assert limits["en"]["max_symbols_per_word"] == 0.05
    assert limits["en"]["max_shouts_per_word"] is None  # good documents shout: no cutoff is safe
    assert limits[None]["max_shouts_per_word"] == 0.05
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, *_ in rows if i % 10}


def test_quality_without_labels_or_documents(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(1, "a b c d e f g h i j", "en", "s"), (2, "too few", None, None), (None, "# " * 9 + "a b c", "en", "s"), (3, None, "en", "s")]
    assert [r["doc_id"] for r in quality.keep_good(docs_of(spark, rows), none).collect()] == [1]
    assert quality.keep_good(docs_of(spark, []), none).count() == 0


# ---- chat formatting

HARD = ["", " ", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>", "[\\INST]", "<<SYS>>a<</SYS>>", "<<s>", "[[INST]", "[ROLE] x\ny [/ROLE]", "a\\", "<", "[", " [/INST]", "</s> ", "é<s>漢", "<s> </s>", "\n\n", "$1 \\1"]


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(3)
    parts = ["<", "[", "\\", "/", "s>", "INST]", "<SYS>>", "ROLE]", " ", "x"]
    some = HARD + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in some], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for t, e, back in df.select("t", "e", chat.unescaped(F.col("e"))).collect():
        assert back == t
        assert not any(c in e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")), t


def read_back(df):
    made = df.select("conv_id", "leaf", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"))
    return {(r["conv_id"], r["leaf"]): ([tuple(x) for x in r["t"]], r["l"]) for r in made.collect()}


def test_turns_and_loss_are_read_back(spark):
    rng = random.Random(5)
    rows = [(c, k, rng.choice(["system", "user", "assistant", "tool", "a\nb [INST]", "", None]), rng.choice([*HARD, None]), "x") for c in [1, 2, 3, None] for k in range(40)]
    rows += [(4, 0, "assistant", "same", "x")] * 3 + [(5, None, "user", "q", "x"), (5, 1, "assistant", "", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    nodes = chat.linear(turns).withColumn("score", F.lit(None).cast("double"))
    found = read_back(chat.format_paths(chat.branches(nodes)))
    by = defaultdict(list)
    for c, k, role, text, _ in rows:
        by[c].append(((k is not None, k or 0), role or "", text or ""))
    assert {c for c, _ in found} == set(by)
    for (c, _), (turns_, loss) in found.items():
        want = [(r, t) for _, r, t in sorted(by[c])]
        assert turns_ == want
        assert loss == "".join(t for r, t in want if r == "assistant")


def test_best_branches_of_trees(spark):
    rows = [
        (1, 0, None, "user", "q", 0.0), (1, 1, 0, "assistant", "low", 1.0), (1, 2, 0, "assistant", "high", 5.0), (1, 3, 2, "user", "next", 0.0),
        (1, 4, 3, "assistant", "end", 4.0), (1, 5, 3, "assistant", "tie", 4.0), (2, 0, None, "user", "alone", None),
        (3, 1, 2, "user", "cycle", 0.0), (3, 2, 1, "user", "cycle", 0.0), (3, 3, 99, "user", "orphan", 0.0),
    ]
    nodes = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double")
    best = read_back(chat.format_paths(chat.branches(nodes)))
    assert {k: [t for _, t in v[0]] for k, v in best.items()} == {(1, 4): ["q", "high", "next", "end"], (2, 0): ["alone"], (3, 3): ["orphan"]}
    every = read_back(chat.format_paths(chat.branches(nodes, best=None)))
    assert set(every) == {(1, 1), (1, 4), (1, 5), (2, 0), (3, 3)}


def test_long_and_empty_conversations(spark):
    turns = spark.range(300).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    found = read_back(chat.format_paths(chat.branches(chat.linear(turns).withColumn("score", F.lit(1.0)))))
    assert [loss for _, loss in found.values()] == ["".join(map(str, range(300)))]
    assert chat.format_paths(chat.branches(chat.linear(turns.limit(0)).withColumn("score", F.lit(1.0)))).count() == 0


# ---- fingerprints


def spark_hash(value, seed=42):
    data = value if isinstance(value, bytes) else value.encode()
    h = xxhash.xxh64_intdigest(data, seed)
    return h - (1 << 64) if h >= 1 << 63 else h


def chain(hashes):
    out = 42
    for h in hashes:
        out = spark_hash((h % (1 << 64)).to_bytes(8, "little"), out % (1 << 64))
    return out


def sketch(text, k=fingerprints.K):
    w = [spark_hash(x) for x in words(text)]
    windows = [w[i : i + 5] for i in range(len(w) - 4)] if len(w) > 4 else [w] if w else []
    return sorted({chain(x) for x in windows})[:k]


def test_sketches_match_brute_force(spark):
    rows = [(i, t, "en", None) for i, t in enumerate(text_rows())]
    df = fingerprints.with_sketch(docs_of(spark, rows), F.col("text"), "sketch")
    assert {r["doc_id"]: r["sketch"] for r in df.collect()} == {i: sketch(t) for i, t, *_ in rows}


def test_parts_merge_into_the_whole_and_estimates_hold(spark):
    rng = random.Random(8)
    lists = [[f"w{rng.randrange(10**6)}" for _ in range(2000)] for _ in range(2)]
    a, b = " ".join(lists[0] + lists[1][:1000]), " ".join(lists[0])
    df = fingerprints.with_sketch(spark.createDataFrame([(1, a), (1, b), (2, None)], "g int, text string"), F.col("text"), "sketch")
    merged = {r["g"]: r["sketch"] for r in fingerprints.merge_groups(df, "g").collect()}
    assert merged == {1: sorted({*sketch(a), *sketch(b)})[: fingerprints.K], 2: []}
    pair = spark.createDataFrame([(sketch(a), sketch(b))], "a array<long>, b array<long>")
    near, inside, n = pair.select(
        fingerprints.resemblance(F.col("a"), F.col("b")), fingerprints.containment(F.col("b"), F.col("a")), fingerprints.distinct_shingles(F.col("a"))
    ).first()
    assert near == pytest.approx(2 / 3, abs=0.15)
    assert inside > 0.8
    assert n == pytest.approx(3000, rel=0.3)


@pytest.mark.parametrize("part_bytes", [1, 200, 1 << 24])
def test_next_document_follows_in_order_over_all_parts(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(fingerprints, "PART_BYTES", part_bytes)
    rng = random.Random(2)
    ids = rng.sample(range(-500, 10**12), 60) + [5, 5, 5]
    rows = [(i, rng.choice([None, "", f"t{k}"]), "en", None) for k, i in enumerate(ids)]
    found = sorted((r["doc_id"], r["text"], r["next_text"]) for r in fingerprints.with_next(docs_of(spark, rows)).collect())
    order = sorted((i, t or "") for i, t, *_ in rows)
    assert found == sorted((i, t, n) for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True))


def test_next_of_one_and_of_none(spark):
    assert [tuple(r) for r in fingerprints.with_next(docs_of(spark, [(None, "x", None, None)])).collect()] == [(None, "x", "x")]
    assert fingerprints.with_next(docs_of(spark, [])).count() == 0


# ---- revisits

RECORDS = "record_id long, kind string, url string, ts long, headers map<string,string>, digest string, status string"


def records(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], RECORDS)


def test_revisits_find_the_latest_earlier_response(spark):
    rows = [
        (1, "response", "http://www.A.com:80/x/?utm_a=1&ref=2#f", 10, {"ETag": '"1"', "Date": "d1", "X": "keep"}, "one"),
        (2, "response", "https://a.com/x", 20, {"etag": 'W/"2"', "Last-Modified": "m", "Set-Cookie": "c"}, "two"),
        (3, "response", "https://a.com/x", 20, {"etag": '"2"', "Last-Modified": "m", "Set-Cookie": "c"}, "three"),
        (4, "revisit", "a.com/x", 15, {"ETAG": 'W/"1"', "date": "d2", "Content-Length": "0"}, None),
        (5, "revisit", "a.com/x/", 20, {"etag": '"2"'}, None), (6, "revisit", "a.com/x", 21, {"etag": '"2"', "Set-Cookie": "no"}, None),
        (7, "revisit", "a.com/x", 22, {"last-modified": "m", "Vary": "v"}, None), (8, "revisit", "a.com/x", 22, {}, None),
        (9, "revisit", "a.com/x", 5, {"etag": '"1"'}, None), (10, "revisit", None, 5, None, None), (11, "revisit", "a.com/x", None, {"etag": '"1"'}, None),
        (6, "revisit", "a.com/x", 21, {"etag": '"2"', "Set-Cookie": "no"}, None),
    ]
    out = sorted(((r["record_id"], r["status"], r["response_id"], r["digest"], r["headers"]) for r in warc.resolve(records(spark, rows)).collect()), key=lambda r: r[0])
    six = (6, "resolved", 3, "three", {"last-modified": "m", "set-cookie": "c", "etag": '"2"'})
    assert out == [
        (4, "resolved", 1, "one", {"x": "keep", "etag": 'W/"1"', "date": "d2"}), (5, "stale", None, None, None), six, six,
        (7, "resolved", 3, "three", {"etag": '"2"', "set-cookie": "c", "last-modified": "m", "vary": "v"}),
        (8, "unchecked", None, None, None), (9, "missing", None, None, None), (10, "missing", None, None, None), (11, "missing", None, None, None),
    ]


@pytest.mark.parametrize("rows_a_slice", [5, 10_000])
def test_as_of_join_over_slices_of_a_hot_key(spark, rows_a_slice):
    rng = random.Random(6)
    have = [(rng.choice(["hot", "hot", "hot", "b", "c"]), rng.randrange(200), f"v{k:03}") for k in range(150)]
    want = [(rng.choice(["hot", "hot", "b", "c", "none"]), rng.randrange(-5, 210)) for _ in range(150)]
    value = spark.createDataFrame(have, "key string, ts long, value string")
    found = warc.latest_before(value, spark.createDataFrame(want, "key string, ts long"), rows_a_slice)
    got = {(r["key"], r["ts"]): r["found"] for r in found.collect()}
    for key, ts in want:
        earlier = [(t, v) for k, t, v in have if k == key and t < ts]
        assert got[(key, ts)] == (max(earlier)[1] if earlier else None)


def test_revisits_of_nothing(spark):
    assert warc.resolve(records(spark, [])).count() == 0
    assert [r["status"] for r in warc.resolve(records(spark, [(1, "revisit", "x", 1, None, None)])).collect()] == ["missing"]


def test_digest_helper():
    assert sha("") == sha(b"")


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 200])
def test_bucket_of_is_a_binary_search(spark, n):
    bounds = [3 * i for i in range(n)]
    df = spark.range(-5, 3 * n + 5).select("id", common.bucket_of(F.col("id"), bounds).alias("b"))
    for i, b in df.collect():
        assert b == max(0, min(max(n - 1, 0), i // 3))
