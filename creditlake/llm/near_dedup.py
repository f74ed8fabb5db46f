"""MinHash near-dedup over an LSH forest.

A document's set holds its distinct 5-word shingles (A-Z lower-cased). Texts
with equal sets form a class, and one text stands for it. Each of TREES trees
takes the minhash values of a class in an order of its own. Classes that agree
on a tree's first DEPTH values share a region; there the rows are sorted by the
values that follow, and each class is a candidate for its neighbours with the
longest common prefix, for the first class of its piece of the region and for
the one nearest to the piece's consensus. Regions are range-partitioned in that
order, neighbours meet across borders, and the leads of pieces meet again.
Classes of regions with more than NEIGHBOURS + 1 classes, where not all meet,
go through an exact prefix join on their full sets afterwards.

Candidates whose estimated similarity is clearly too low are left out (a pair
at the threshold is missed with a probability of about 1e-5); links are
confirmed on the full sets. Two classes at 0.75 share no region with a
probability of (1 - 0.75**DEPTH)**TREES, about 2e-6. Confirming goes by rounds:
first a likely partner of each class, then all candidates that are not
connected yet.

Nulls: a null or empty text has the empty set and is linked with nothing. Rows
with one id are one document. Rows without an id are one document for each
distinct text, never a component's smallest while another has an id; a
component without any id reports null. Repeated rows are equal, and one text
stands for a class however many rows have it. Ties: of equal candidates the
smaller class goes first. A very long text is one row. Empty tables give empty
results; other columns are ignored, and ``keep_one`` passes them through under
any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import kept, packed, shipped, spread_lookup, whole
from creditlake.llm.components import components
from creditlake.llm.grams import Texts, U, batches, chained, joined, mixed, word_units
from creditlake.llm.repeats import cut_by, group_heads

SHINGLE = 5
VALUES = 128
TREES = 16
DEPTH = 2
STRIDE = VALUES // TREES
NEIGHBOURS = 4
BATCH_BYTES = 1 << 18
PERCENT = 75
LEAST_ESTIMATE = 0.58
SPLIT = 4096
LAST = 10_000
RARE = 32
HOT = 1_000
#: Classes that share a shingle are counted up to this.
MOST = 2**31 - 1
LIKELY = 0.85
#: Ids from here on are made from the text of a row without one.
MADE_ID = 1 << 62
_random = np.random.default_rng(77)
FACTORS = _random.integers(0, 2**63, VALUES, dtype=U) * U(2) + U(1)
SIGNED = "id long, n int, cls long, cls2 long, sig binary, keys array<long>"
PAIRS = "a long, b long, ra long, rb long, est int"


def sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, each text's ascending, and where each text's begin."""
    grams = word_units(texts, lower=True)
    count = np.bincount(grams.owner, minlength=len(texts))
    heads = np.cumsum(count) - count
    shingles = chained(grams.hashes, SHINGLE)
    own = grams.owner[: len(shingles)]
    good = own == grams.owner[SHINGLE - 1 :] if len(shingles) else own > 0
    few = np.flatnonzero((count > 0) & (count < SHINGLE))
    short = grams.hashes[heads[few]] if len(few) else np.zeros(0, U)
    for k in range(1, SHINGLE - 1):
        more = count[few] > k
        short[more] = joined(short[more] + U(k), grams.hashes[heads[few][more] + k])
    value = np.concatenate([shingles[good], short])
    owner = np.concatenate([own[good], few])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    one = group_heads(owner, value) if len(value) else order
    value, owner = value[one], owner[one]
    return value, np.searchsorted(owner, np.arange(len(texts) + 1))


def class_hashes(value: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each set."""
    full = np.flatnonzero(np.diff(begins))
    heads = begins[:-1][full]
    cls, cls2 = np.zeros(len(begins) - 1, U), np.zeros(len(begins) - 1, U)
    if len(full):
        cls[full], cls2[full] = np.add.reduceat(mixed(value), heads), np.add.reduceat(mixed(value ^ FACTORS[0]), heads)
    return mixed(cls + np.diff(begins).astype(U)), cls2


def signatures(value: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each set: two hashes, a byte of each minhash value, and the keys of its regions."""
    n = len(begins) - 1
    full = np.flatnonzero(np.diff(begins))
    heads = begins[:-1][full]
    cls, cls2 = class_hashes(value, begins)
    low = np.zeros((n, VALUES), U)
    if len(full):
        for k in range(VALUES):
            low[full, k] = np.minimum.reduceat(value * FACTORS[k], heads)
    low = mixed(low)
    keys = np.empty((n, TREES), U)
    for t in range(TREES):
        key = np.full(n, U(t + 1))
        for d in range(DEPTH):
            key = joined(key, low[:, t * STRIDE + d])
        keys[:, t] = key
    return cls, cls2, (low & U(0xFF)).astype(np.uint8), keys


def own_id(doc_id: str, text: str) -> Column:
    """The id of a row; one made from its text if it has none."""
    made = F.xxhash64(whole(F.col(text))).bitwiseAND(F.lit(MADE_ID - 1).cast("long")) + F.lit(MADE_ID).cast("long")
    return F.coalesce(F.col(doc_id).cast("long"), made)


def signed_rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    shipped(docs.sparkSession)
    own = docs.select(own_id(doc_id, text).alias("id"), F.col(text).cast("string").alias("text"))

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            texts = Texts.of(row.column("text"))
            for at, to in batches(np.diff(texts.begins), BATCH_BYTES):
                begins = texts.begins[at : to + 1]
                value, where = sets(Texts(texts.data[begins[0] : begins[-1]], begins - begins[0]))
                cls, cls2, low, keys = signatures(value, where)
                flat = pa.array(keys.view(np.int64).ravel())
                columns = [
                    row.column("id").slice(at, to - at),
                    pa.array(np.diff(where).astype(np.int32)),
                    pa.array(cls.view(np.int64)),
                    pa.array(cls2.view(np.int64)),
                    pa.array([x.tobytes() for x in low], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(to - at + 1, dtype=np.int32) * TREES), flat),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "cls", "cls2", "sig", "keys"])

    return kept(own.mapInArrow(sign, SIGNED))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity in percent; equal bytes of unequal values are allowed for."""
    equal = np.count_nonzero(a == b, axis=1) / VALUES
    return np.rint(100 * (equal - 1 / 256) / (1 - 1 / 256)).astype(np.int32)


def region_pairs(members: DataFrame, piece: int, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Candidates among the rows (key, tree, cls, rep, n, sig, size) of each region, and the rows (key, tree, cls) that have to meet again.

    Rows are range-partitioned in their order, so a region may lie in many
    tasks, and a task holds ``piece`` rows at a time. A row meets its
    neighbours across pieces, as the last ones of a piece go into the next;
    the outer rows of a task and the leads of a region in pieces meet again.
    """

    def walk(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, outer = None, None
        for row in rows:
            for at in range(0, row.num_rows, piece):
                own = pa.Table.from_batches([row.slice(at, piece)])
                if outer is None or len(outer) < NEIGHBOURS:
                    outer = own.slice(0, NEIGHBOURS) if outer is None else pa.concat_tables([outer, own]).slice(0, NEIGHBOURS)
                own = own if held is None else pa.concat_tables([held, own])
                yield candidates(own)
                held = own.slice(max(0, len(own) - NEIGHBOURS))
        if held is not None:
            yield met_again(pa.concat_tables([outer, held]))

    ddl = "a long, b long, ra long, rb long, est int, lead boolean, key long, tree int"
    order = ("key", "turn", "cls")
    # The tree's order goes on after the values of the key, around the end; 32 of them decide.
    turn = F.substring(F.concat("sig", "sig"), F.col("tree") * STRIDE + DEPTH + 1, F.lit(32))
    rows = members.withColumn("turn", turn)
    dealt = rows.repartitionByRange(parts, *order) if parts else rows.repartitionByRange(*order)
    found = kept(dealt.sortWithinPartitions(*order).drop("turn").mapInArrow(walk, ddl))
    return found.where("not lead").drop("lead", "key", "tree"), found.where("lead").select("key", "tree", F.col("a").alias("cls")).distinct()


def met_again(rows: pa.Table) -> pa.RecordBatch:
    none = np.zeros(len(rows), np.int64)
    columns = {"a": np.asarray(rows.column("cls")), "b": none, "ra": none, "rb": none, "est": none.astype(np.int32)}
    columns |= {"lead": np.ones(len(rows), bool), "key": np.asarray(rows.column("key")), "tree": np.asarray(rows.column("tree"))}
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def candidates(table: pa.Table) -> pa.RecordBatch:
    key, tree, cls, rep, n, whole = (np.asarray(table.column(c)) for c in ("key", "tree", "cls", "rep", "n", "size"))
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(-1, VALUES)
    head = group_heads(key)
    size = np.diff(np.append(head, len(key)))
    region = np.repeat(np.arange(len(head)), size)
    i = np.arange(len(key))
    pairs = [(i[:-k][region[:-k] == region[k:]], i[k:][region[:-k] == region[k:]]) for k in range(1, NEIGHBOURS + 1)]
    first = head[:0]
    if len(key):
        first = np.lexsort((rep, region))[head]
    pairs.append((np.repeat(first, size), i))
    leads = [first]
    for r in np.flatnonzero(size > NEIGHBOURS):
        rows = np.arange(head[r], head[r] + size[r])
        counts = np.bincount((sig[rows].astype(np.int64) + 256 * np.arange(VALUES)).ravel(), minlength=256 * VALUES)
        centre = rows[np.argmax(np.count_nonzero(sig[rows] == counts.reshape(VALUES, 256).argmax(1).astype(np.uint8), axis=1))]
        pairs.append((np.full(len(rows), centre), rows))
        leads.append(np.array([centre]))
    x, y = (np.concatenate(p) for p in zip(*pairs, strict=True))
    swap = cls[x] > cls[y]
    x, y = np.where(swap, y, x), np.where(swap, x, y)
    fits = (cls[x] != cls[y]) & (100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y]))
    x, y = np.divmod(np.unique(x[fits] * len(key) + y[fits]), max(1, len(key)))
    est = np.concatenate([estimate(sig[x[k : k + 50_000]], sig[y[k : k + 50_000]]) for k in range(0, len(x), 50_000)] or [np.zeros(0, np.int32)])
    good = est >= 100 * LEAST_ESTIMATE
    x, y, est = x[good], y[good], est[good]
    lead = np.unique(np.concatenate(leads))
    lead = lead[size[region[lead]] < whole[lead]]  # only regions in pieces need someone to stand for them
    none = np.zeros(len(lead), np.int64)
    columns = {
        "a": np.concatenate([cls[x], cls[lead]]),
        "b": np.concatenate([cls[y], none]),
        "ra": np.concatenate([rep[x], none]),
        "rb": np.concatenate([rep[y], none]),
        "est": np.concatenate([est, none]).astype(np.int32),
        "lead": np.append(np.zeros(len(x), bool), np.ones(len(lead), bool)),
        "key": np.concatenate([key[x], key[lead]]),
        "tree": np.concatenate([tree[x], tree[lead]]).astype(np.int32),
    }
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})


def forest_pairs(classes: DataFrame, split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b, ra, rb, est) of classes, each once, and the classes of regions where not all meet."""
    spread = classes.select("cls", F.posexplode("keys").alias("tree", "key"))
    rows = TREES * classes.count()
    crowded = kept(packed(spread.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), rows))
    of = classes.select("cls", "rep", "n", "sig")
    members = kept(spread.join(crowded, "key").join(of, "cls"))
    crowd = kept(packed(members.where(F.col("size") > NEIGHBOURS + 1).select("cls").distinct(), rows))
    found, again = region_pairs(members, split)
    rounds = [found]
    while True:
        again = kept(packed(again, rows))
        left = again.count()
        sized = again.join(again.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "key").join(of, "cls")
        if left <= LAST:
            rounds.append(region_pairs(sized, LAST, 1)[0])
            break
        found, again = region_pairs(sized, LAST, -(-left // LAST))
        rounds.append(found)
    every = reduce(DataFrame.unionByName, rounds)
    return kept(packed(every.groupBy("a", "b", "ra", "rb").agg(F.max("est").alias("est")), rows)), crowd


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(cls, grams) of each class, once; ``texts`` has (cls, text), also texts of other classes."""

    def listed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for at in range(0, row.num_rows, 256):
                part = row.slice(at, 256)
                value, begins = sets(Texts.of(part.column("text")))
                grams = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(value.view(np.int64)))
                good = pa.array(class_hashes(value, begins)[0].view(np.int64) == part.column("cls").to_numpy())
                yield pa.RecordBatch.from_arrays([part.column("cls"), grams], ["cls", "grams"]).filter(good)

    return texts.mapInArrow(listed, "cls long, grams array<long>").groupBy("cls").agg(F.first("grams").alias("grams"))


def spread_join(rows: DataFrame, small: DataFrame) -> DataFrame:
    """Join on ``g`` to one row a shingle of ``small``, which ``size`` of the rows have; the ones of many rows don't meet in one task."""
    hot = small.where(F.col("size") > HOT)
    tried = spread_lookup(rows, hot, "g", F.col("cls"))
    rest = tried.where("size is null").select(*rows.columns).join(small.where(F.col("size") <= HOT), "g")
    return tried.where("size is not null").unionByName(rest)


def crowd_links(crowd: DataFrame, texts: DataFrame, rare: int = RARE) -> DataFrame:
    """All similar pairs (a, b) of the classes ``crowd`` (cls, n, label) of different labels, but for links that follow from others.

    A prefix join, exact: in an order by rarity two similar sets share one of
    their first n - ceil(0.75 n) + 1 shingles. Those that at most ``rare``
    classes share are joined. What is left shares no rare shingle, so it must
    be similar by the common shingles alone: a class stays if these are at
    least 0.75 of it, and of each pair they are 6/7 of one (``top``). Of a
    label's classes with the same common shingles the smallest stays. The
    next round joins by the shingles that few tops have, and so on.
    """
    classes, shingles = crowd.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    items = kept(packed(crowd.join(shingle_sets(texts), "cls").withColumn("top", F.lit(True)), shingles))
    full = items.select("cls", "grams")
    need = F.ceil(F.col("n") * PERCENT / 100)
    links = []

    def fits(o: Column) -> Column:
        enough = (100 + PERCENT) * F.least(F.col("left"), o["left"]) >= PERCENT * (F.col("n") + o["n"])
        return (F.col("label") != o["label"]) & enough & (~F.col("top") | (F.col("cls") < o["cls"]))

    while True:
        if items.where("top").isEmpty():
            return reduce(DataFrame.unionByName, links) if links else crowd.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
        # Pairs of one label need no link, so only shingles of several labels count.
        each = items.select("cls", "label", "top", F.explode("grams").alias("g"))
        shared = each.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.count_if("top").alias("df"), F.min("label").alias("l"), F.max("label").alias("m"))
        wanted = packed(shared.where("l <> m and df > 0").select("g", "size", F.least("df", F.lit(MOST)).cast("int").alias("df")), shingles)
        met = packed(spread_join(each.select("cls", "g"), kept(wanted)), shingles)
        order = met.groupBy("cls").agg(F.array_sort(F.collect_list(F.struct("df", "g"))).alias("order"))
        order = items.drop("grams").join(order, "cls").withColumn("left", F.size("order")).where(F.col("left") >= need)
        # Stored as plain arrays, 12 bytes a shingle.
        flat = [F.transform("order", lambda s: s["g"]).alias("g"), F.transform("order", lambda s: s["df"]).alias("df")]
        order = kept(packed(order.select("cls", "n", "label", "top", "left", *flat), shingles))
        heads = [F.slice(c, F.lit(1), (F.col("left") - need + 1).cast("int")).alias(c) for c in ("g", "df")]
        first = order.select("cls", "n", "label", "top", "left", F.inline(F.arrays_zip(*heads)))
        first = first.where(F.col("df") <= rare).drop("df")
        one_top = F.when(F.col("top"), F.struct("cls", "n", "label", "left"))
        tops = first.groupBy("g").agg(F.collect_list(one_top).alias("tops"), F.count(F.lit(1)).alias("size")).where(F.size("tops") > 0)
        apart = spread_join(first, kept(packed(tops, shingles))).withColumn("o", F.explode(F.filter("tops", lambda o: fits(o))))
        pairs = packed(apart.select(F.least("cls", "o.cls").alias("a"), F.greatest("cls", "o.cls").alias("b")), shingles).distinct()
        both = pairs.join(full.toDF("a", "ga"), "a").join(full.toDF("b", "gb"), "b")
        similar = both.where((100 + PERCENT) * F.size(F.array_intersect("ga", "gb")) >= PERCENT * (F.size("ga") + F.size("gb"))).select("a", "b")
        links.append(kept(packed(similar, shingles)))
        over = F.size(F.filter("df", lambda d: d > rare))
        common = order.select("cls", "n", "label", "top", F.slice("g", F.size("g") - over + 1, over).alias("grams"))
        common = common.where(F.size("grams") >= need).withColumn("top", (100 + PERCENT) * F.size("grams") >= 2 * PERCENT * F.col("n"))
        same = common.groupBy("label", F.xxhash64(F.array_sort("grams")).alias("common"))
        one = F.min_by(F.struct("cls", "n", "label", "grams", "top"), F.struct("n", "cls")).alias("one")
        items = kept(packed(same.agg(one).select("one.*"), shingles))
        rare *= 16


def texts_of(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(cls, text): one text for each of the classes ``wanted`` (cls, rep), where rep is the id of a row of the class.

    An id may have rows of several classes and a class many rows, so a row's
    class is found again, and rows of a class are combined where they are read.
    """
    own = docs.select(own_id(doc_id, text).alias("rep"), F.col(text).cast("string").alias("text"))
    rows = own.join(wanted.select("rep").distinct(), "rep", "left_semi").select("text")

    def classed(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in batches_:
            for at in range(0, row.num_rows, 256):
                part = row.slice(at, 256)
                value, begins = sets(Texts.of(part.column("text")))
                cls = pa.array(class_hashes(value, begins)[0].view(np.int64))
                yield pa.RecordBatch.from_arrays([cls, part.column("text")], ["cls", "text"])

    found = rows.mapInArrow(classed, "cls long, text string").join(wanted.select("cls").distinct(), "cls", "left_semi")
    return kept(found.groupBy("cls").agg(F.min("text").alias("text")))


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; ``texts`` has (cls, text)."""

    def similar(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows:
            for at in range(0, row.num_rows, 256):
                part = row.slice(at, 256)
                (x, xs), (y, ys) = (sets(Texts.of(part.column(c))) for c in ("text_a", "text_b"))
                (ca, _), (cb, _) = class_hashes(x, xs), class_hashes(y, ys)
                good = (ca.view(np.int64) == part.column("a").to_numpy()) & (cb.view(np.int64) == part.column("b").to_numpy())
                size = np.array([len(np.intersect1d(x[xs[i] : xs[i + 1]], y[ys[i] : ys[i + 1]], True)) for i in range(part.num_rows)])
                union = np.diff(xs) + np.diff(ys) - size
                keep = pa.array(good & (100 * size >= PERCENT * union))
                yield part.select(["a", "b"]).filter(keep)

    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b"))
    return kept(pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(similar, "a long, b long").distinct())


def found_components(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(id, n_shingles, component) of every row; ids from MADE_ID on stand for rows without one."""
    rows = signed_rows(docs, doc_id, text)
    n_rows = rows.count()
    first = F.min_by(F.struct("sig", "keys"), "id")
    classes = kept(
        rows.where("n > 0").groupBy("cls", "cls2", "n").agg(F.min("id").alias("rep"), first.alias("s")).select("cls", "rep", "n", "s.sig", "s.keys")
    )
    pairs, crowd = forest_pairs(classes)
    crowd = crowd.join(classes.select("cls", "rep", "n"), "cls")
    wanted = pairs.select(F.col("a").alias("cls"), F.col("ra").alias("rep")).union(pairs.select("b", "rb")).union(crowd.select("cls", "rep")).distinct()
    n_pairs = pairs.count()
    texts = texts_of(docs, packed(wanted, 2 * n_pairs + n_rows), doc_id, text)
    # Rows of one document that are in several classes connect these.
    named_rows = rows.where((F.col("n") > 0) & (F.col("id") < MADE_ID))
    several = packed(named_rows.groupBy("id").agg(F.min("cls").alias("a"), F.max("cls").alias("z")).where("a <> z"), n_rows)
    ties = named_rows.join(several, "id").select("a", F.col("cls").alias("b")).where("a <> b").distinct()

    either = pairs.select("a", "b", F.col("b").alias("of"), F.col("ra").alias("to"), "est").union(
        pairs.select("a", "b", F.col("a"), F.col("rb"), "est")
    )
    likely = F.struct((F.col("est") >= 100 * LIKELY).alias("likely"), F.when(F.col("est") >= 100 * LIKELY, -F.col("to")).otherwise(F.col("est")), "a", "b")
    chosen = packed(either.groupBy("of").agg(F.max(likely).alias("best")).select("best.a", "best.b"), n_pairs)
    chosen = kept(packed(chosen.distinct(), n_pairs))
    most = n_pairs + n_rows  # links between classes and ties: a row ties its class to at most one other
    labels = kept(packed(components(confirm(chosen, texts).union(ties), most), most))
    la = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    lb = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    rest = pairs.join(chosen, ["a", "b"], "left_anti").join(la, "a", "left").join(lb, "b", "left")
    rest = kept(packed(rest.where("la is null or lb is null or la <> lb").select("a", "b"), n_pairs))
    links = confirm(rest, texts).union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
    labels = kept(packed(components(links, most + n_rows), most))
    # Classes of crowded regions met only some of the others there.
    labelled = crowd.join(labels.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "n", F.coalesce("label", "cls").alias("label"))
    links = crowd_links(kept(packed(labelled, n_rows)), texts.join(crowd.select("cls"), "cls", "left_semi"))
    links = links.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
    labels = kept(packed(components(links, links.count()), n_rows))

    named = rows.where("n > 0").select("cls", "id").distinct().join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    label = F.coalesce("label", "cls")
    least = named.groupBy(label.alias("label")).agg(F.min("id").alias("component"))
    by_class = kept(packed(named.select("cls", label.alias("label")).distinct().join(least, "label").select("cls", "component"), n_rows))
    # Empty texts share a class but no link; they don't go through the join.
    out = rows.where("n > 0").join(by_class, "cls", "left").select("id", "n", "component")
    out = out.unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component")))
    return out.select("id", F.col("n").cast("long").alias("n_shingles"), "component")


def near_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row."""
    found = found_components(docs, doc_id, text)
    real = [F.when(F.col(c) < MADE_ID, F.col(c)) for c in ("id", "component")]
    return found.select(real[0].alias("doc_id"), "n_shingles", real[1].alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest of their component; of equal rows without an id, one."""
    found = found_components(docs, doc_id, text).where("id = component").select("id").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own_id(doc_id, text).alias("id"))
    stay = rows.join(found, "id", "left_semi")
    named = stay.where(F.col("id") < MADE_ID)
    unnamed = stay.where(F.col("id") >= MADE_ID).dropDuplicates(["id"])
    return named.unionByName(unnamed).select("row.*")
