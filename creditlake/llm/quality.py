"""Quality rules with risk-controlled thresholds.

Fixed base rules drop fragments and repetitive texts. Further rules compare a
measure of the document with a cutoff. The cutoffs come from labelled rows: in
each stratum and for each rule, the strictest cutoff for which an exact
binomial test shows that at most ``risk / rules`` of the good documents are
rejected. The error level is divided by the number of strata, rules and
cutoffs tried (Bonferroni), so with probability 1 - ``error`` no stratum loses
more than ``risk`` of its good documents. A rule without a cutoff that passes
is off in that stratum.

Nulls: a null text has no words (base rules reject it); a null stratum is a
stratum of its own; labels with null id or null quality are left out, and an
id labelled both ways counts as bad. Repeated rows are judged alike, and a
measure equal to its cutoff passes. A very long text is one row, whose windows
are sorted in it. A column named __f is taken. Empty
tables give an empty result, and without labels only the base rules act.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditlake.llm.common import kept, spread_lookup, whole, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
RISK = 0.02
ERROR = 0.05
#: Share of the measure above which a document goes; tried from the strictest.
CUTOFFS = (0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7)
MEASURES = ("symbols_per_word", "shouts_per_word", "upper_share", "dup_line_share")


def repeat_words(tokens: str, count: str) -> tuple[Column, Column, Column, Column]:
    """Steps (to be put in columns one after the other) towards the words in windows found twice or more.

    Windows are compared by a 64-bit hash within one document. Where two hashes
    are equal, sorting (hash, position) pairs brings equal windows together, so
    the work is n log n in the words of the document, also for very long ones;
    a document without equal hashes is done after one pass over plain numbers.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.col(count) - F.lit(WINDOW)),
        lambda i: F.xxhash64(*[F.get(F.col(tokens), i + j) for j in range(WINDOW)]),
    )
    hashes = F.when(F.col(count) >= WINDOW, hashes)
    own = F.col("__hashes")
    placed = F.transform(own, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    windows = F.when(F.size(F.array_distinct(own)) < F.size(own), F.sort_array(placed))
    at = F.col("__windows")
    found = F.sort_array(
        F.transform(
            F.filter(at, lambda x, k: (x["h"] == F.get(at, k - 1)["h"]) | (x["h"] == F.get(at, k + 1)["h"])),
            lambda x: x["i"],
        )
    )
    starts = F.col("__starts")
    covered = F.aggregate(
        F.transform(starts, lambda x, k: F.coalesce(F.least(F.get(starts, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return hashes, windows, found, F.coalesce(covered, F.lit(0).cast("long"))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``__f`` of the counts that the rules use."""
    body = whole(F.col(text))
    lines = F.filter(F.split(body, "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    hashes, windows, found, covered = repeat_words("__words", "__n")
    counts = {
        "n_words": F.col("__n"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": covered,
        "n_lines": F.size("__lines"),
        "n_shouts": F.regexp_count(body, F.lit("!")),
        "n_upper": F.regexp_count(body, F.lit(r"\p{Lu}")),
    }
    return (
        docs.withColumn("__words", words(F.col(text)))
        .withColumn("__lines", lines)
        .withColumn("__n", F.size("__words"))
        .withColumn("__hashes", hashes)
        .withColumn("__windows", windows)
        .withColumn("__starts", found)
        # Generated, so that a filter on the counts is not pushed below them, where each would be made many times.
        .withColumn("__f", F.explode(F.array(F.struct(*[c.cast("long").alias(k) for k, c in counts.items()]))))
        .drop("__words", "__lines", "__n", "__hashes", "__windows", "__starts")
    )


def base_failed() -> Column:
    few = F.col("__f.n_words") < MIN_WORDS
    return few | (100 * F.col("__f.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("__f.n_words"))


def measures() -> dict[str, Column]:
    def share(part: str, of: str) -> Column:
        return F.when(F.col(f"__f.{of}") > 0, F.col(f"__f.{part}") / F.col(f"__f.{of}")).otherwise(0.0)

    return {
        "symbols_per_word": share("n_symbols", "n_words"),
        "shouts_per_word": share("n_shouts", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
    }


def passes(rejected: Column, good: Column, risk: float, level: Column) -> Column:
    """Exact binomial test: were the rate ``risk``, at most ``rejected`` of ``good`` would be rarer than ``level``.

    The sum of the binomial's terms runs in logarithms, so large counts do not underflow.
    """
    odds = F.log(F.lit(risk / (1 - risk)))
    first = good * F.log(F.lit(1 - risk))
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] + F.log((good - j + 1) / j) + odds
        high, low = F.greatest(state["total"], term), F.least(state["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(rejected > 0, F.sequence(F.lit(1).cast("long"), rejected)).otherwise(F.array().cast("array<bigint>"))
    total = F.aggregate(steps, start, add, lambda s: s["total"])
    return F.when(rejected < risk * good, total <= F.log(level)).otherwise(False)


def thresholds(
    labelled: DataFrame, stratum: str = "stratum", risk: float = RISK, error: float = ERROR, cutoffs: tuple[float, ...] = CUTOFFS
) -> DataFrame:
    """One row a stratum: the cutoff of each measure, null where no cutoff passes.

    ``labelled`` has the good documents' measures. Counts per stratum are
    summed before the shuffle; the result has a row for each stratum.
    """
    counts = [
        F.count(F.when(F.col(m) > c, 1)).alias(f"{m}_{k}") for m in MEASURES for k, c in enumerate(cutoffs)
    ]
    counted = kept(labelled.groupBy(stratum).agg(F.count(F.lit(1)).alias("good"), *counts))
    tests = max(1, counted.count()) * len(MEASURES) * len(cutoffs)

    def strictest(m: str) -> Column:
        certified = [
            F.when(passes(F.col(f"{m}_{k}"), F.col("good"), risk / len(MEASURES), F.lit(error / tests)), F.lit(c))
            for k, c in enumerate(cutoffs)
        ]
        return F.coalesce(*certified).alias(f"max_{m}")

    return kept(counted.select(stratum, *[strictest(m) for m in MEASURES]))


def calibrate(
    scored: DataFrame, labels: DataFrame, doc_id: str = "doc_id", stratum: str = "lang", **settings
) -> DataFrame:
    """The thresholds from the rows of ``scored`` (see features) that are labelled good and pass the base rules."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id")
    good = known.agg(F.min("quality").alias("q")).where("q = 1").select(F.col("doc_id").alias("__id"))
    passed = scored.where(~base_failed()).select(
        F.col(doc_id).alias("__id"), F.col(stratum).alias("stratum"), *[c.alias(m) for m, c in measures().items()]
    )
    return thresholds(passed.join(good, "__id", "left_semi"), **settings)


def verdict(scored: DataFrame, limits: DataFrame, doc_id: str = "doc_id", stratum: str = "lang") -> DataFrame:
    """``scored`` (see features) with booleans ``__failed`` (base rules) and ``__kept``."""
    small = limits.select(F.col("stratum").alias("__stratum"), F.struct(*[f"max_{m}" for m in MEASURES]).alias("__max"))
    out = spread_lookup(scored.withColumn("__stratum", F.col(stratum)), small, "__stratum", F.col(doc_id))
    rejected = base_failed()
    for m, value in measures().items():
        rejected = rejected | F.coalesce(value > F.col(f"__max.max_{m}"), F.lit(False))
    return out.withColumn("__failed", base_failed()).withColumn("__kept", ~rejected).drop("__stratum", "__max")


def scores(docs: DataFrame, doc_id: str = "doc_id", stratum: str = "lang", text: str = "text") -> DataFrame:
    """Ids, strata and counts, without the texts, kept: the base of calibrate() and verdict()."""
    return kept(features(docs.select(doc_id, stratum, text), text).drop(text))


def keep_good(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", stratum: str = "lang", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass. Rows are stored once with their counts, which both the thresholds and the verdict read."""
    scored = kept(features(docs, text))
    limits = calibrate(scored, labels, doc_id, stratum)
    return verdict(scored, limits, doc_id, stratum).where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])
