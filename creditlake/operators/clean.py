"""Cleaning of raw credit actions into the ``user_actions`` contract.

Steps (the original order, which matters):

1. parse the mixed-format timestamp (native expression);
2. drop rows where org_id and user_id are both missing;
3. single-organisation rule on the *raw* strings: per raw user_id, the first
   non-null org_id ordered by (timestamp ascending with unparsed last, file
   order) is the user's organisation; rows of any other org are dropped, as are
   rows with a missing org_id or user_id;
4. missing timestamps become the 1990-01-01 sentinel;
5. text columns are stripped of Unicode whitespace and lower-cased;
6. missing credits become 1.0, missing credit_type becomes 'default'.

``normalise_first=True`` moves step 5 before step 3 (then ``' ORG_1 '`` and
``'org_1'`` are one organisation, and cleaning is idempotent).

The per-user first organisation is a hash aggregate with map-side combine: time
and file order are packed into one decimal whose minimum is taken per (user,
organisation), so the raw rows are neither sorted nor collected by user. It is
joined back by ``skew_join``: users of very many rows have their one row
repeated over salts, so that their rows spread over many tasks when Spark has
to shuffle (a small side it broadcasts by itself).
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditlake.functions.text import normalise_text
from creditlake.functions.timestamps import NUMBER_RE, parse_mixed_timestamp
from creditlake.plans.materialize import materialize
from creditlake.plans.skew import skew_join
from creditlake.schemas import (
    DEFAULT_CREDIT_TYPE,
    DEFAULT_CREDITS,
    FACT_COLUMNS,
    RAW_TEXT_COLUMNS,
    SENTINEL_TIMESTAMP,
)


@dataclass(frozen=True)
class CleanOptions:
    normalise_first: bool = False
    meridiem: str = "ignore"
    hot_rows: int | None = None  # rows of one user that a task may hold; None: the session's bound
    # Off by default, as in the source: keep the first row (file order) per
    # (org_id, user_id, credit_type, timestamp) after cleaning.
    dedup: bool = False
    # The exploration notebook's variant: apply the single-organisation rule a
    # second time on the normalised, filled rows (sentinel dates sort first then).
    rule_again_after_normalise: bool = False


def parse_timestamps(raw: DataFrame, meridiem: str = "ignore") -> DataFrame:
    """``timestamp`` text → timestamp (NULL when no shape matches)."""
    return raw.withColumn("timestamp", parse_mixed_timestamp(F.col("timestamp"), meridiem))


def parse_credits(col) -> F.Column:
    """Credits text → double; non-numbers (e.g. '12d') are NULL."""
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    return F.when(text.rlike(NUMBER_RE), text.try_cast("double"))


def normalise_strings(df: DataFrame) -> DataFrame:
    """F3 + F4 on the four text columns."""
    return df.withColumns({c: normalise_text(F.col(c)) for c in RAW_TEXT_COLUMNS})


def fill_defaults(df: DataFrame) -> DataFrame:
    """Sentinel timestamp, default credits, default credit type."""
    return df.withColumns(
        {
            "timestamp": F.coalesce(F.col("timestamp"), F.lit(SENTINEL_TIMESTAMP).cast("timestamp")),
            "credits": F.coalesce(F.col("credits"), F.lit(DEFAULT_CREDITS)),
            "credit_type": F.coalesce(F.col("credit_type"), F.lit(DEFAULT_CREDIT_TYPE)),
        }
    )


def prepare(raw: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Typed raw rows: parsed timestamp, numeric credits (and normalised text if asked)."""
    df = parse_timestamps(raw, options.meridiem).withColumn("credits", parse_credits("credits"))
    if options.normalise_first:
        df = normalise_strings(df)
    return df


# Microseconds since year 1 fit 18 digits (unparsed: the largest such number); a
# shifted 64-bit sequence number fits the 20 digits below.
_UNPARSED = 10**18 - 1
_YEAR_ONE_MICROS = -62_135_596_800_000_000
_SEQ_SPAN = Decimal(10**20)
_SEQ_SHIFT = Decimal(2**63)


def packed_order(timestamp: F.Column, number: F.Column) -> F.Column:
    """(unparsed, timestamp, number) as one decimal(38,0) of the same order.

    A decimal is a mutable aggregation buffer, so its minimum is a hash
    aggregate; a struct's would sort the rows.
    """
    since = F.unix_micros(timestamp) - F.lit(_YEAR_ONE_MICROS).cast("long")
    high = F.coalesce(since, F.lit(_UNPARSED).cast("long")).cast("decimal(18,0)") * F.lit(_SEQ_SPAN)
    low = number.cast("decimal(20,0)") + F.lit(_SEQ_SHIFT)
    return (high + low).cast("decimal(38,0)")


def _file_order(df: DataFrame) -> tuple[list[F.Column], F.Column]:
    """Grouping columns and the number that together give the file order of ``seq``.

    A number is itself; a CSV scan's (file, block, row) groups by file and
    block, within which rows are numbered.
    """
    kind = df.schema["seq"].dataType
    if isinstance(kind, T.StructType):
        return [F.col("seq.file").alias("file"), F.col("seq.block").alias("block")], F.col("seq.row")
    if isinstance(kind, T.IntegralType):
        return [F.lit("").alias("file"), F.lit(0).cast("long").alias("block")], F.col("seq")
    raise TypeError(f"seq must be an integer or a (file, block, row) struct, not {kind.simpleString()}")


def first_orgs(df: DataFrame, org_breaks_ties: bool = False) -> DataFrame:
    """W1 with counts: (user_id, first_org, user_rows) for every user with at least one non-null org."""
    blocks, number = _file_order(df)
    per_org = (
        df.where(F.col("user_id").isNotNull() & F.col("org_id").isNotNull())
        .groupBy("user_id", "org_id", *blocks)
        .agg(F.min(packed_order(F.col("timestamp"), number)).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    moment = F.expr(f"first div {_SEQ_SPAN}")
    order_key = F.struct(moment, *([F.col("org_id")] if org_breaks_ties else []), "file", "block", "first")
    # Rows of this second step: one a user, organisation and block.
    return per_org.groupBy("user_id").agg(F.min_by("org_id", order_key).alias("first_org"), F.sum("n").alias("user_rows"))


def first_org_per_user(df: DataFrame, org_breaks_ties: bool = False) -> DataFrame:
    """(user_id, first_org) for every user with at least one non-null org.

    Order: timestamp ascending, unparsed timestamps last, then ``seq``. With
    ``org_breaks_ties`` the org_id comes before ``seq``: the notebook has sorted
    its rows by (org_id, user_id) before its second pass, and its sorts are stable.
    """
    return first_orgs(df, org_breaks_ties).drop("user_rows")


def annotate_first_org(
    df: DataFrame,
    hot_rows: int | None = None,
    org_breaks_ties: bool = False,
    strategy: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Attach ``first_org`` to every row (NULL when the user has none).

    ``counted``: the same rows under an Observation, read for the first organisations in place of ``df``.
    """
    firsts = materialize(first_orgs(df if counted is None else counted, org_breaks_ties), "first-orgs")
    return skew_join(df, firsts, "user_id", "user_rows", hot_rows, strategy)


def single_org_filter(
    df: DataFrame,
    hot_rows: int | None = None,
    org_breaks_ties: bool = False,
    strategy: str | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """P1 + P2: drop rows without both ids, keep each user's first organisation.

    A row kept has both ids, so rows with a missing one never enter the join.
    """
    kept = df.where(F.col("org_id").isNotNull() & F.col("user_id").isNotNull())
    return (
        annotate_first_org(kept, hot_rows, org_breaks_ties, strategy, counted)
        .where(F.col("org_id") == F.col("first_org"))
        .drop("first_org")
    )


def finish(df: DataFrame, normalised: bool, keep_seq: bool = False) -> DataFrame:
    """Steps 4-6 and the contract projection."""
    if not normalised:
        df = normalise_strings(df)
    df = fill_defaults(df)
    cols = list(FACT_COLUMNS) + (["seq"] if keep_seq else [])
    return df.select(*cols)


def with_given(raw: DataFrame, options: CleanOptions) -> tuple[DataFrame, list[F.Column]]:
    """``prepare(raw)`` marked with the values that were given, and the counts of Q7 that need no join."""
    given = {f"_has_{c}": F.col(c).isNotNull() for c in ("timestamp", "credits")}
    org, user = F.col("org_id").isNull(), F.col("user_id").isNull()
    counts = {
        "rows_in": F.count(F.lit(1)),
        "dropped_missing_ids": F.count_if(org & user),
        "dropped_org_missing": F.count_if(org & ~user),
        "dropped_user_missing": F.count_if(user & ~org),
        "unparsed_timestamps": F.count_if(F.col("_has_timestamp") & F.col("timestamp").isNull()),
        "unparsed_credits": F.count_if(F.col("_has_credits") & F.col("credits").isNull()),
    }
    return prepare(raw.withColumns(given), options), [c.alias(k) for k, c in counts.items()]


def observed_report(
    counts: Observation, rows_out: int, raw: DataFrame, options: CleanOptions = CleanOptions()
) -> dict[str, int]:
    """Q7 from the counts of a finished ``clean`` and the rows that were stored.

    ``dropped_other_org`` is what is left: rows with both ids that the rule (or
    a second pass or de-duplication, if chosen) dropped. A task that a lost
    executor makes Spark run again may add its rows to the counts twice;
    ``cleaning_report`` counts anew. If nothing was stored, Spark may have cut
    the observed step from an empty plan, so ``raw`` is counted instead.
    """
    if rows_out:
        seen = counts.get
    else:
        rows, columns = with_given(raw, options)
        seen = rows.agg(*columns).first().asDict()
    out = {k: int(v) for k, v in seen.items()}
    missing = out["dropped_missing_ids"] + out["dropped_org_missing"] + out["dropped_user_missing"]
    out["dropped_other_org"] = out["rows_in"] - missing - rows_out
    out["dropped_org_rule"] = out["rows_in"] - out["dropped_missing_ids"] - rows_out
    out["rows_out"] = rows_out
    return out


def clean(
    raw: DataFrame, options: CleanOptions = CleanOptions(), keep_seq: bool = False, counts: Observation | None = None
) -> DataFrame:
    """Raw text rows (with ``seq``) → ``user_actions`` rows.

    ``counts`` observes the rows while the first organisations are made, so
    that ``observed_report`` needs no pass of its own.
    """
    typed = prepare(raw, options)
    counted = None
    if counts is not None:
        rows, columns = with_given(raw, options)
        counted = rows.observe(counts, *columns)
    kept = single_org_filter(typed, options.hot_rows, counted=counted)
    if not (options.dedup or options.rule_again_after_normalise):
        return finish(kept, normalised=options.normalise_first, keep_seq=keep_seq)
    out = finish(kept, normalised=options.normalise_first, keep_seq=True)
    if options.rule_again_after_normalise:
        out = single_org_filter(out, options.hot_rows, org_breaks_ties=True)
    if options.dedup:
        from creditlake.operators.explore import dedup_actions

        out = dedup_actions(out)
    return out if keep_seq else out.drop("seq")


def normalise_and_fill(raw: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """F1-F7 without the row rules: every raw row, typed, normalised and filled."""
    typed = prepare(raw, options)
    return finish(typed, normalised=options.normalise_first, keep_seq=True)


def cleaning_report(raw: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Q7: one row of counts in one pass.

    rows_in; dropped_missing_ids (both ids missing); dropped_org_rule (every other
    drop), split into dropped_org_missing, dropped_user_missing and
    dropped_other_org (a second organisation); rows_out.
    """
    typed = prepare(raw, options)
    annotated = annotate_first_org(typed, options.hot_rows)
    org, user = F.col("org_id"), F.col("user_id")
    both_missing = org.isNull() & user.isNull()
    kept = F.coalesce(org == F.col("first_org"), F.lit(False))
    return annotated.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(both_missing).alias("dropped_missing_ids"),
        F.count_if(~both_missing & ~kept).alias("dropped_org_rule"),
        F.count_if(org.isNull() & user.isNotNull()).alias("dropped_org_missing"),
        F.count_if(user.isNull() & org.isNotNull()).alias("dropped_user_missing"),
        F.count_if(org.isNotNull() & user.isNotNull() & ~kept).alias("dropped_other_org"),
        F.count_if(kept).alias("rows_out"),
    )
