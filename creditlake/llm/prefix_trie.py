"""Conversation prefix trie: what conversations share with the ones that begin alike.

A conversation's path holds a 128-bit digest of (role, text) for each of its
turns. Paths are range-partitioned in their order, so a shard holds a stretch
of the trie. A shard's trie is a string of balanced parentheses, one pair a
node in depth-first order; ``Parens`` finds the closing one of each node by the
least excess of blocks, blocks of blocks, and so on. That delimits the node's
subtree, and differences of running sums over the parentheses give its leaf
pairs "()", its members and its savings.

What a node has outside its shard is on the shard's first or last path, its
spines. Nodes off these are finished in the shard. A spine travels as one row:
its path and, for each node on it, what hangs there off the spines. FAN
neighbouring shards' spines are paths of a smaller trie, built and summed by
the same code, and so on until one is left; a round's task holds 2 FAN paths.
Ids of the conversations that end at a spine node leave the shard as one piece
of text a shard, and a node's pieces are hashed in order, one after the other.

Nulls: rows without a conversation id are left out; a null role or text is
empty, a null turn comes first. Rows of one turn go by role, then text, and
repeated rows are turns of their own. An empty table gives no nodes. A
conversation's digests stay in one row, its texts do not. Columns other than
the four named ones are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import kept, parts_for, shipped, spread_lookup, whole, words
from creditlake.llm.grams import spans

KEY = 16
SHARD_BYTES = 8 << 20
FAN = 32
BLOCK = 64
ARITY = 16
SEARCHED = 1 << 14
SUMS = ("members", "leaves", "children", "saved", "least")
NO_ID = np.iinfo(np.int64).max
NODES = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
#: Kinds of rows that a shard gives: finished nodes, spines, and ids that end at a spine node.
NODE, SPINE, ENDS = 0, 1, 2
ROWS = f"kind int, {NODES}, key string, parent_key string, shard int, path binary, sums binary"
NAMES = [f.strip().split(" ")[0] for f in ROWS.split(",")]


class Parens:
    """Balanced parentheses with the least excess of blocks, in levels of ARITY."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1), dtype=np.int32)
        low, self.levels = self.excess, []
        size = BLOCK
        while True:
            pad = np.full(-len(low) % size, np.iinfo(np.int32).max, np.int32)
            low = np.append(low, pad).reshape(-1, size).min(axis=1)
            self.levels.append(low)
            if len(low) == 1:
                return
            size = ARITY

    @staticmethod
    def _first(values: np.ndarray, begins: np.ndarray, width: int, after: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first place behind ``after``, of ``width`` from ``begins`` on, with a value <= target, or -1."""
        at = begins[:, None] + np.arange(width)
        inside = np.minimum(at, len(values) - 1)
        fits = (values[inside] <= target[:, None]) & (at > after[:, None]) & (at < len(values))
        found = fits.argmax(axis=1)
        return np.where(fits[np.arange(len(found)), found], begins + found, -1)

    def find_close(self, places: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the next place whose excess is one less."""
        out = np.empty(len(places), np.int64)
        for at in range(0, len(places), SEARCHED):
            out[at : at + SEARCHED] = self._find(places[at : at + SEARCHED])
        return out

    def _find(self, places: np.ndarray) -> np.ndarray:
        target = self.excess[places] - 1
        found = self._first(self.excess, places // BLOCK * BLOCK, BLOCK, places, target)
        block = places // BLOCK
        left = np.flatnonzero(found < 0)
        # Up: the first later block among the siblings, of ever larger blocks.
        waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
        own = block[left]
        for level, low in enumerate(self.levels):
            if not len(left):
                break
            hit = self._first(low, own // ARITY * ARITY, ARITY, own, target[left])
            waiting.append((level, left[hit >= 0], hit[hit >= 0]))
            left, own = left[hit < 0], own[hit < 0] // ARITY
        # Down again: into the block found, to its first child that is low enough.
        rows, blocks = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for level, more, hit in reversed(waiting):
            rows, blocks = np.append(rows, more), np.append(blocks, hit)
            values, width = (self.levels[level - 1], ARITY) if level else (self.excess, BLOCK)
            blocks = self._first(values, blocks * width, width, np.full(len(rows), -1), target[rows]) if len(rows) else blocks
        found[rows] = blocks
        return found


def agreeing(keys: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many keys each path has in common with the one before it, from the first on."""
    both = np.minimum(sizes[1:], sizes[:-1])
    out = np.zeros(len(sizes), np.int64)
    some = np.flatnonzero(both)
    if len(some):
        width = both[some]
        differ = keys[spans(heads[:-1][some], width)] != keys[spans(heads[1:][some], width)]
        begins = np.cumsum(width) - width
        place = np.where(differ.any(axis=1), np.arange(width.sum()) - np.repeat(begins, width), np.repeat(width, width))
        out[some + 1] = np.minimum.reduceat(place, begins)
    return out


class Trie:
    """The trie of sorted paths: a node for each prefix, in depth-first order, as parentheses."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray):
        heads = np.cumsum(sizes) - sizes
        self.shared = agreeing(keys, heads, sizes)
        new = sizes - self.shared
        self.first_new = 1 + np.cumsum(new) - new
        self.size = 1 + int(new.sum())
        #: Where a node's last key is, and its depth; the root has none.
        self.turn = np.append(-1, spans(heads + self.shared, new))
        self.depth = np.append(0, spans(self.shared + 1, new))
        closes = np.append(0, sizes[:-1] - self.shared[1:])
        runs = np.stack([closes, new], axis=1).ravel()
        opens = np.repeat(np.tile([False, True], len(sizes)), runs)
        self.parens = Parens(np.concatenate([[True], opens, np.zeros(sizes[-1] + 1, bool)]))
        self.open = np.flatnonzero(self.parens.opens)
        self.close = self.parens.find_close(self.open)
        self.last = np.arange(self.size) + (self.close - self.open + 1) // 2 - 1
        # The parent is the last node before that is one less deep.
        place = np.sort(self.depth * self.size + np.arange(self.size))
        before = np.searchsorted(place, (self.depth - 1) * self.size + np.arange(self.size)) - 1
        self.parent = np.where(self.depth > 0, place[before] - (self.depth - 1) * self.size, -1)

    def ends(self, sizes: np.ndarray) -> np.ndarray:
        """The node at which each path ends; one that adds none equals the path before."""
        new = sizes > self.shared
        at = np.where(new, self.first_new + sizes - self.shared - 1, 0)
        return np.maximum.accumulate(at)

    def within(self, values: np.ndarray) -> np.ndarray:
        """Sums of the nodes' values over their subtrees."""
        total = np.append(0, np.cumsum(values))
        return total[self.last + 1] - total[np.arange(self.size)]

    def leaf_pairs(self) -> np.ndarray:
        """Is the node a pair "()"?"""
        return self.close == self.open + 1

    def least_within(self, values: np.ndarray) -> np.ndarray:
        """The least value in each subtree, by overlapping spans of doubled length."""
        size = self.last - np.arange(self.size) + 1
        out, step, low = np.array(values), 1, values
        while step <= self.size:
            mine = np.flatnonzero((size >= step) & (size < 2 * step))
            out[mine] = np.minimum(low[mine], low[self.last[mine] - step + 1])
            if 2 * step > self.size:
                break
            low = np.minimum(low[: len(low) - step], low[step:])
            step *= 2
        return out


def totals(trie: Trie, hang: dict[str, np.ndarray], words_of: np.ndarray, spine: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over subtrees; the nodes on a ``spine`` are not finished, so they are no leaves yet and save nothing."""
    children = hang["children"] + np.bincount(trie.parent[1:], minlength=trie.size)
    members = trie.within(hang["members"])
    leaf = trie.leaf_pairs() & (hang["children"] == 0) & ~spine
    own = np.where(spine, 0, (members - 1) * words_of)
    return {
        "members": members,
        "children": children,
        "leaves": trie.within(hang["leaves"] + leaf),
        "saved": trie.within(hang["saved"] + own),
        "least": trie.least_within(hang["least"]),
    }


def node_keys(path: np.ndarray) -> list[str]:
    """A name for each node on a path, from the root on."""
    running = hashlib.md5()
    out = [running.hexdigest()]
    for turn in path:
        running.update(turn.tobytes())
        out.append(running.hexdigest())
    return out


def spines(trie: Trie, sizes: np.ndarray, final: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, which): the nodes on the first and the last path, and which nodes are on either."""
    first = np.arange(sizes[0] + 1)
    last = np.flatnonzero(trie.last == trie.size - 1)  # subtrees that reach to the end
    which = np.zeros(trie.size, bool)
    if not final:
        which[first], which[last] = True, True
    return first, last, which


def rows_of(trie: Trie, sum_: dict[str, np.ndarray], spine: np.ndarray, digests: dict[int, str], names: dict[int, str]) -> dict[str, list]:
    """Finished nodes as columns; those under a spine name their parent by its key."""
    done = np.flatnonzero(~spine)
    parent = trie.parent[done]
    known = (parent >= 0) & ~spine[parent]
    n = len(done)
    return {
        "kind": [NODE] * n,
        "conv_id": sum_["least"][done].tolist(),
        "depth": trie.depth[done].tolist(),
        "parent_conv_id": [x if k else None for x, k in zip(sum_["least"][parent].tolist(), known.tolist(), strict=True)],
        "n_convs": sum_["members"][done].tolist(),
        "n_children": sum_["children"][done].tolist(),
        "n_leaves": sum_["leaves"][done].tolist(),
        "saved_tokens": sum_["saved"][done].tolist(),
        "ends_sha256": [digests.get(i) for i in done.tolist()],
        "key": [names.get(i) for i in done.tolist()],
        "parent_key": [None if k or p < 0 else names[p] for p, k in zip(parent.tolist(), known.tolist(), strict=True)],
    }


def spine_rows(trie: Trie, sum_: dict[str, np.ndarray], shard: int, paths: list[np.ndarray], counts: list[np.ndarray], nodes: list[np.ndarray], spine: np.ndarray) -> list[dict]:
    """The first and last path with what hangs at their nodes; nodes on both are told with the first."""
    off = np.flatnonzero(~spine)
    off = off[spine[trie.parent[off]]]  # finished children of spine nodes
    at = trie.parent[off]
    hang = {c: np.array(sum_["own_" + c]) for c in SUMS}
    for c in ("members", "leaves", "saved"):
        np.add.at(hang[c], at, sum_[c][off])
    np.add.at(hang["children"], at, 1)
    np.minimum.at(hang["least"], at, sum_["least"][off])
    out = []
    told = np.zeros(trie.size, bool)
    for side, (path, count, own) in enumerate(zip(paths, counts, nodes, strict=True)):
        nothing = {c: NO_ID if c == "least" else 0 for c in SUMS}
        sums = np.stack([np.where(told[own], nothing[c], hang[c][own]) for c in SUMS])
        told[own] = True
        # Both sides of a spine go on: the words of its turns, and what hangs at its nodes.
        out.append({"kind": SPINE, "shard": 2 * shard + side, "path": path.tobytes(), "sums": np.vstack([sums, np.append(0, count)]).astype(np.int64).tobytes()})
    return out


def table_of(columns: dict[str, list], extra: list[dict], schema: pa.Schema) -> pa.Table:
    n = len(columns["kind"])
    nodes = pa.Table.from_arrays([pa.array(columns.get(f.name, [None] * n), f.type) for f in schema], schema=schema)
    return pa.concat_tables([nodes, pa.Table.from_pylist(extra, schema)])


def arrow_schema() -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.strip().split(" ") for f in ROWS.split(","))])


def finished(trie: Trie, hang: dict[str, np.ndarray], words_of: np.ndarray, spine: np.ndarray) -> dict[str, np.ndarray]:
    sum_ = totals(trie, hang, words_of, spine)
    return sum_ | {"own_" + c: hang[c] for c in SUMS}


def listed(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


def shard_rows(shard: int, ids: np.ndarray, path: list[bytes], counts: list[np.ndarray]) -> pa.Table:
    """What a shard of conversations, sorted by path and id, gives."""
    sizes = np.array([len(p) // KEY for p in path])
    keys = np.frombuffer(b"".join(path), np.uint64).reshape(-1, 2)
    words_of = np.append(np.concatenate(counts) if len(keys) else np.zeros(0, np.int64), 0)
    trie = Trie(keys, sizes)
    end = trie.ends(sizes)
    hang = {c: np.zeros(trie.size, np.int64) for c in SUMS}
    hang["members"] = np.bincount(end, minlength=trie.size)
    hang["least"] = np.full(trie.size, NO_ID)
    np.minimum.at(hang["least"], end, ids)
    first, last, spine = spines(trie, sizes, False)
    sum_ = finished(trie, hang, words_of[trie.turn], spine)
    edges = np.flatnonzero(np.append(True, end[1:] != end[:-1]))
    groups = dict(zip(end[edges].tolist(), np.split(ids, edges[1:]), strict=True))
    digests = {i: hashlib.sha256(listed(x).encode()).hexdigest() for i, x in groups.items() if not spine[i]}
    names = dict(zip(last.tolist(), node_keys(np.frombuffer(path[-1], np.uint64).reshape(-1, 2)), strict=True))
    names |= dict(zip(first.tolist(), node_keys(np.frombuffer(path[0], np.uint64).reshape(-1, 2)), strict=True))
    nobody = hashlib.sha256(b"").hexdigest()
    columns = rows_of(trie, sum_, spine, {i: digests.get(i, nobody) for i in np.flatnonzero(~spine).tolist()}, {i: names[i] for i in np.flatnonzero(spine).tolist()})
    outer = [np.frombuffer(path[i], np.uint64).reshape(-1, 2) for i in (0, -1)]
    extra = spine_rows(trie, sum_, shard, outer, [counts[0], counts[-1]], [first, last], spine)
    extra += [{"kind": ENDS, "key": names[i], "shard": shard, "path": listed(x).encode()} for i, x in groups.items() if spine[i]]
    return table_of(columns, extra, arrow_schema())


def merged(table: pa.Table, shard: int, final: bool) -> pa.Table:
    """The spines of neighbouring shards as one: nodes that are inner now, and its own spines."""
    table = table.sort_by("shard")
    paths = [np.frombuffer(p, np.uint64).reshape(-1, 2) for p in table.column("path").to_pylist()]
    sums = [np.frombuffer(s, np.int64).reshape(len(SUMS) + 1, -1) for s in table.column("sums").to_pylist()]
    sizes = np.array([len(p) for p in paths])
    trie = Trie(np.concatenate(paths), sizes)
    hang = {c: np.full(trie.size, NO_ID) if c == "least" else np.zeros(trie.size, np.int64) for c in SUMS}
    words_of, names = np.zeros(trie.size, np.int64), {}
    own = np.zeros(0, np.int64)
    held = []
    for i, path in enumerate(paths):
        own = np.append(own[: trie.shared[i] + 1] if i else np.zeros(1, np.int64), trie.first_new[i] + np.arange(sizes[i] - trie.shared[i]))
        held.append(own)
        for k, c in enumerate(SUMS):
            if c == "least":
                hang[c][own] = np.minimum(hang[c][own], sums[i][k])
            else:
                hang[c][own] += sums[i][k]
        words_of[own] = sums[i][-1]
        names |= dict(zip(own.tolist(), node_keys(path), strict=True))
    _, _, spine = spines(trie, sizes, final)
    sum_ = finished(trie, hang, words_of, spine)
    columns = rows_of(trie, sum_, spine, {}, names)
    extra = [] if final else spine_rows(trie, sum_, shard, [paths[0], paths[-1]], [sums[0][-1][1:], sums[-1][-1][1:]], [held[0], held[-1]], spine)
    return table_of(columns, extra, arrow_schema())


def meeting(final: bool):
    def met(key: tuple, table: pa.Table) -> pa.Table:
        return merged(table, key[0].as_py(), final)

    return met


def rebuilt(turns: DataFrame, head_turns: Column, base: Column) -> DataFrame:
    """(conv_id, turns): each conversation with its first turns replaced by those of its base.

    ``head_turns`` and ``base`` are columns of ``conv_id``. A turn is the
    hexadecimal digest of its role and text, and the words of the text.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    own = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    told = F.struct(F.row_number().over(order).alias("i"), digest.alias("key"), F.size(words(F.col("text"))).alias("n"))
    listed_ = own.select("conv_id", told.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    listed_ = kept(listed_.withColumn("head", head_turns).withColumn("base", base))
    bases = listed_.select(F.col("conv_id").alias("base"), F.col("turns").alias("given"))
    met = listed_.join(bases, "base", "left")
    given = F.coalesce(F.slice("given", F.lit(1), F.col("head")), F.array().cast(bases.schema["given"].dataType))
    rest = F.slice("turns", F.col("head") + 1, F.size("turns"))
    return met.select("conv_id", F.concat(F.when(F.col("head") > 0, given).otherwise(F.slice("turns", 1, 0)), rest).alias("turns"))


def nodes(conversations: DataFrame, shard_bytes: int = SHARD_BYTES, fan: int = FAN) -> DataFrame:
    """The trie of conversations (conv_id, turns as by ``rebuilt``): a row a node."""
    spark = shipped(conversations.sparkSession)
    path = F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))
    paths = kept(conversations.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["n"].cast("long")).alias("counts")))
    size = paths.agg(F.sum(F.length("path") + 24)).first()[0] or 0
    n = parts_for(spark, size, shard_bytes)
    dealt = paths.repartitionByRange(n, "path", "conv_id").sortWithinPartitions("path", "conv_id").withColumn("shard", F.spark_partition_id())

    def build(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [r for r in rows if r.num_rows]
        if batches:
            own = pa.Table.from_batches(batches)
            counts = [np.asarray(x, np.int64) for x in own.column("counts").to_pylist()]
            yield from shard_rows(own.column("shard")[0].as_py(), own.column("conv_id").to_numpy(), own.column("path").to_pylist(), counts).to_batches(1 << 16)

    made = kept(dealt.mapInArrow(build, ROWS))
    node_names = [*NAMES[1:9], "key", "parent_key"]
    done, left, ends = made.where(F.col("kind") == NODE).select(*node_names), made.where(F.col("kind") == SPINE), made.where(F.col("kind") == ENDS)
    n = 1 + (left.agg(F.max("shard")).first()[0] or 0) // 2
    while True:
        final = n <= fan
        n = -(-n // fan)
        group = F.floor(F.col("shard") / (2 * fan)).cast("int")
        met = kept(left.select(group.alias("group"), "shard", "path", "sums").groupBy("group").applyInArrow(meeting(final), ROWS))
        done = done.unionByName(met.where(F.col("kind") == NODE).select(*node_names))
        if final:
            return settled(done, ends)
        left = met.where(F.col("kind") == SPINE)


def settled(done: DataFrame, ends: DataFrame) -> DataFrame:
    """Finished nodes with their parents' ids, and the digests of ids that end at a spine node."""

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running, comma = None, None, b""
        for row in rows:
            out = []
            for k, piece in zip(row.column("key").to_pylist(), row.column("path").to_pylist(), strict=True):
                if k != key:
                    out.append((key, running))
                    key, running, comma = k, hashlib.sha256(), b""
                running.update(comma + piece)
                comma = b","
            told = [(k, r.hexdigest()) for k, r in out if k is not None]
            yield pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in told], pa.string()), "ends": pa.array([r for _, r in told], pa.string())})
        if key is not None:
            yield pa.RecordBatch.from_pydict({"key": pa.array([key]), "ends": pa.array([running.hexdigest()])})

    order = ends.select("key", "shard", "path").repartition("key").sortWithinPartitions("key", "shard")
    digests = kept(order.mapInArrow(hashed, "key string, ends string"))
    late = done.where(F.col("key").isNotNull())
    early = done.where(F.col("key").isNull())
    nobody = F.sha2(F.lit("").cast("binary"), 256)
    late = late.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends", nobody)).drop("ends")
    all_ = early.unionByName(late.select(*early.columns))
    owners = kept(done.where(F.col("key").isNotNull()).select(F.col("key").alias("parent_key"), F.col("conv_id").alias("owner")))
    named = all_.where(F.col("parent_key").isNotNull())
    other = all_.where(F.col("parent_key").isNull())
    found = spread_lookup(named, owners, "parent_key", F.xxhash64("conv_id", "depth"))
    out = other.unionByName(found.withColumn("parent_conv_id", F.col("owner")).select(*other.columns))
    return out.select(*NAMES[1:9]).withColumn("depth", F.col("depth").cast("long"))
