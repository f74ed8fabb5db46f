"""Chat formatting over reply trees.

Messages form trees (each names the message it answers). Self-joins that
double the distance to a known ancestor find every leaf's path to its root in
about log2(depth) rounds; branches are ranked by score, and each chosen path
becomes one conversation: a formatted text and the spans of it that count for
the loss (the assistant's texts).

Template, with CONTROL the fixed set of control strings:

    system     <<SYS>> text <</SYS>>
    user       [INST] text [/INST]
    assistant  <s> text </s>
    other      [ROLE] role newline text [/ROLE]   (the role URL-encoded)

Inside texts a control string gets a backslash after its first character (one
more, if it has some there already), so no control string of the template can
occur in a text, and taking one backslash away gives the text back.

Nulls: a null text or role is the empty one. Repeated rows are turns of their
own; ties in the turn are ordered by role and text. Rows without a conversation
id form one conversation. A message whose parent is unknown is a root; messages
on a cycle have no root and appear in no path. A very long text is escaped as
any other, and a path's texts meet in one row. Empty tables give an empty
result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditlake.llm.common import kept, whole

INSIDE = r"(?=\\*(?:/?s>|</?SYS>>|/?INST\]|/?ROLE\]))"
TURN = r"(?s)<<SYS>> (?:.*?) <</SYS>>|\[INST\] (?:.*?) \[/INST\]|<s> (?:.*?) </s>|\[ROLE\] (?:.*?) \[/ROLE\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=[<\[])" + INSIDE, r"\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?<=[<\[])\\" + INSIDE, "")


def linear(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as trees of one branch: each turn answers the one before."""
    clean = turns.select(
        F.col("conv_id"), F.col("turn"), whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text")
    )
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return clean.select("conv_id", at.alias("node"), "role", "text").withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))


def ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The tables of 2^i-th ancestors (conv_id, node, up), and the depth of each node that has a root."""
    links = nodes.select("conv_id", "node", "parent")
    known = links.select(F.col("conv_id").alias("c"), F.col("node").alias("n"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("n"))
    linked = kept(links.join(known, same, "left").select("conv_id", "node", F.col("n").alias("up")))
    depth = linked.where("up is null").select("conv_id", "node", F.lit(0).alias("depth"))
    jump, jumps = linked.where("up is not null"), []
    while not jump.isEmpty():
        # Nodes at depth d in [2^i, 2^(i+1)) hang 2^i below a node whose depth is known already.
        jumps.append(jump)
        step = 1 << (len(jumps) - 1)
        above = depth.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "depth")
        on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("n"))
        found = kept(jump.join(above, on).select("conv_id", "node", (F.col("depth") + step).alias("depth")))
        if found.isEmpty():  # only cycles are left
            break
        depth = depth.unionByName(found)
        more = jump.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), F.col("up").alias("next"))
        jump = kept(jump.join(more, on).select("conv_id", "node", F.col("next").alias("up")))
    return jumps, depth


def paths(nodes: DataFrame) -> DataFrame:
    """Rows (conv_id, leaf, node, depth): every root-to-leaf path."""
    jumps, depth = ancestors(nodes)
    parents = nodes.select(F.col("conv_id").alias("c"), F.col("parent").alias("n"))
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
    rows = kept(depth.join(parents, on, "left_anti").select("conv_id", F.col("node").alias("leaf"), "node", "depth"))
    for i in range(len(jumps)):
        # What is known covers distances below 2^i from the leaf; one join adds as many again.
        up = jumps[i].select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "up")
        added = rows.join(up, on).select("conv_id", "leaf", F.col("up").alias("node"), F.col("depth") - (1 << i))
        rows = kept(rows.unionByName(added.toDF(*rows.columns)))
    return rows


def branches(nodes: DataFrame, best: int | None = 1) -> DataFrame:
    """Messages of the ``best`` branches of each tree (all, if None), with ``leaf`` and ``depth``.

    A branch's score is the mean of its messages' ``score``; ties go to the
    longer branch, then to the smaller leaf.
    """
    steps = paths(nodes)
    own = nodes.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "role", "text", "score")
    on = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
    full = steps.join(own, on).drop("c", "n")
    if best is None:
        return full
    score = F.coalesce(F.avg("score"), F.lit(0.0))
    ranked = full.groupBy("conv_id", "leaf").agg(score.alias("branch_score"), F.max("depth").alias("length"))
    order = Window.partitionBy("conv_id").orderBy(F.desc("branch_score"), F.desc("length"), "leaf")
    chosen = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    chosen = chosen.select(F.col("conv_id").alias("c"), F.col("leaf").alias("l"))
    return full.join(chosen, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("leaf") == F.col("l")), "left_semi")


def format_paths(messages: DataFrame) -> DataFrame:
    """One row a path: ``formatted`` and ``loss_spans``, [start, length) in code points of it."""
    body = escaped(F.col("text"))
    lead = (
        F.when(F.col("role") == "system", "<<SYS>> ").when(F.col("role") == "user", "[INST] ").when(F.col("role") == "assistant", "<s> ")
        .otherwise(F.concat(F.lit("[ROLE] "), F.url_encode("role"), F.lit("\n")))
    )
    tail = (
        F.when(F.col("role") == "system", " <</SYS>>").when(F.col("role") == "user", " [/INST]").when(F.col("role") == "assistant", " </s>")
        .otherwise(" [/ROLE]")
    )
    before = Window.partitionBy("conv_id", "leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (
        messages.select("conv_id", "leaf", "depth", "role", lead.alias("lead"), body.alias("body"), tail.alias("tail"))
        .withColumn("piece", F.concat("lead", "body", "tail"))
        .withColumn("at", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0).cast("long")) + F.length("lead"))
    )
    span = F.when(F.col("role") == "assistant", F.struct(F.col("at").alias("start"), F.length("body").alias("length")))
    turns = F.array_sort(F.collect_list(F.struct("depth", "piece", span.alias("span"))))
    return (
        pieces.groupBy("conv_id", "leaf")
        .agg(turns.alias("turns"))
        .select(
            "conv_id",
            "leaf",
            F.array_join(F.col("turns.piece"), "").alias("formatted"),
            F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """Structs (role, text) read back from a formatted text."""

    def inner(t: Column, lead: int, tail: int) -> Column:
        return unescaped(F.substring(t, F.lit(lead + 1), F.length(t) - (lead + tail)))

    def turn(t: Column) -> Column:
        line = F.locate("\n", t)
        role = F.url_decode(F.substring(t, F.lit(8), line - 8))
        text = unescaped(F.substring(t, line + 1, F.length(t) - line - 8))

        def pair(r: Column, x: Column) -> Column:
            return F.struct(r.alias("role"), x.alias("text"))

        return (
            F.when(t.startswith("<<SYS>>"), pair(F.lit("system"), inner(t, 8, 9)))
            .when(t.startswith("[INST]"), pair(F.lit("user"), inner(t, 7, 8)))
            .when(t.startswith("<s>"), pair(F.lit("assistant"), inner(t, 4, 5)))
            .otherwise(pair(role, text))
        )

    return F.transform(F.regexp_extract_all(formatted, F.lit(TURN), F.lit(0)), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    texts = F.transform(spans, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"])))
    return F.array_join(texts, "")
