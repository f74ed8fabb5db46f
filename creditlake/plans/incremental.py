"""Incremental refresh of the marts: replaced days in, only touched days and organisations rewritten.

Two tables are kept in one folder:

* ``days``: the daily rollup, a partition folder a period (a day, or a
  longer one where a day has few rows; the other days of a touched period are
  carried over);
* ``state``: per (org, user, action, credit_type) the exact sums over all days
  and the days that have rows, in partition folders by a hash of the org.

A rollup key has at most one row a day, and the sums are exact decimals and
counts. So a replaced day leaves the state by subtraction and by removing the
day from the array, and enters it by addition: what a refresh computes equals
what a full rebuild would (no sum drifts, no distinct count is estimated). The
inexact rest of an amount (NaN, more than four decimals) can't be subtracted;
it stays with its day in the array.

A refresh writes the touched periods and parts as a new generation beside the old
ones, then one directory per table that names the generation of every period and
part, and at last one row in ``manifest``. Readers take the newest manifest row,
so they see both tables of one version; a refresh that fails before that row
changes nothing for them. Earlier versions stay readable (``version=``).

``ledger()`` turns the state into ledger rows that every mart function accepts:
the sums on a row without a day, and the days on rows of zeros.

NULLs in any key are keys of their own; rows without a timestamp share the NULL
day, which is replaced when ``changed`` holds such rows or ``days`` holds None.
An empty ``changed`` without ``days`` is a refresh that touches nothing.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.operators import marts as M
from creditlake.plans.materialize import materialize, stage_scope
from creditlake.session import checkpoint_dir

STATE_KEYS = ("org_id", "user_id", "action", "credit_type")
MEASURES = ("main", "n", "n_amount")
AMOUNT = "struct<main: decimal(38,0), rest: double>"
DAYS = "array<struct<day: date, rest: double>>"
DAY, PERIOD, PART, GENERATION = "activity_date", "period", "part", "generation"


@dataclass(frozen=True)
class IncrementalMarts:
    spark: SparkSession
    folder: str
    parts: int = 64
    period: str = "day"

    # --- reading ------------------------------------------------------------

    def version(self) -> int:
        """The newest complete version; 0 before the first refresh."""
        return self._manifest().agg(F.max("version")).first()[0] or 0

    def days(self, version: int | None = None) -> DataFrame:
        """The daily rollup of a version (default: the newest)."""
        return self._current("days", PERIOD, "date", version).select(*M.LEDGER_COLUMNS)

    def state(self, version: int | None = None) -> DataFrame:
        """(org, user, action, credit_type, sums, days) of a version."""
        return self._current("state", PART, "int", version).select(*STATE_KEYS, *MEASURES, "days", PART)

    def ledger(self, version: int | None = None) -> DataFrame:
        """The state as ledger rows: sums once a key, days (with their rests) on rows that count nothing."""
        state = self.state(version)

        def amount(main, rest):  # NULL where all credits are, as in a sum of them
            return F.when(F.col("n_amount") > 0, F.struct(main.alias("main"), rest.alias("rest"))).alias("amount")

        zero = F.lit(0).cast("long")
        sums = state.select(F.lit(None).cast("date").alias(DAY), *STATE_KEYS, amount(F.col("main"), F.lit(0.0)), "n", "n_amount")
        each = state.withColumn("day", F.explode("days"))
        days = each.select(
            F.col("day.day").alias(DAY), *STATE_KEYS, amount(F.lit(0).cast("decimal(38,0)"), F.col("day.rest")),
            zero.alias("n"), zero.alias("n_amount"),
        )
        return sums.unionByName(days)

    def marts(self, organizations: DataFrame, users: DataFrame, as_of=None, version: int | None = None) -> dict[str, DataFrame]:
        """The five marts of one version: the daily one from ``days``, the others from the state."""
        version = self.version() if version is None else version
        ledger = self.ledger(version)
        return {
            "customer_success_daily_activity": M.cs_daily_activity(self.days(version), rolled_up=True),
            "finance_org_credit_balance": M.finance_org_balance(ledger),
            "enhanced_customer_success_view": M.cs_user_mart(ledger, organizations, users, as_of),
            "enhanced_finance_view": M.finance_mart(ledger, organizations),
            "executive_summary_view": M.executive_summary(ledger, organizations, users, materialize=False),
        }

    # --- refreshing ---------------------------------------------------------

    def refresh(self, changed: DataFrame, days: Iterable[dt.date | None] | None = None) -> int:
        """Replace whole days by the fact rows ``changed`` and return the new version.

        The replaced days are those of ``changed`` and those named in ``days``
        (a day named there without rows becomes empty). Rows of ``changed``
        are all rows of their days.
        """
        before = self.version()
        version = before + 1
        attempt = uuid.uuid4().hex  # a failed refresh leaves files that no directory names
        with stage_scope(self.spark):
            new = materialize(M.daily_rollup(changed), "incremental-new")
            named = self.spark.createDataFrame([(d,) for d in days or ()], f"{DAY} date")
            touched = materialize(new.select(DAY).union(named).distinct(), "incremental-days")
            periods = touched.select(self._period().alias(PERIOD)).distinct()
            same = F.col(PERIOD).eqNullSafe(F.col("_period"))
            reopened = self._current("days", PERIOD, "date", before).join(periods.withColumnRenamed(PERIOD, "_period"), same, "left_semi")
            replaced = touched.withColumnRenamed(DAY, "_day"), F.col(DAY).eqNullSafe(F.col("_day"))
            old = reopened.join(*replaced, "left_semi").select(*M.LEDGER_COLUMNS)
            carried = reopened.join(*replaced, "left_anti").select(*M.LEDGER_COLUMNS)
            days_now = new.select(*M.LEDGER_COLUMNS).unionByName(carried).withColumn(PERIOD, self._period())
            self._write(days_now, "days", PERIOD, version, attempt)
            self._write_directory("days", PERIOD, days_now.select(PERIOD), periods, before, version, attempt)

            delta = materialize(self._delta(new, old), "incremental-delta")
            parts = materialize(delta.select(PART).distinct(), "incremental-parts")
            merged = materialize(self._merged(self.state(before).join(parts, PART, "left_semi"), delta), "incremental-state")
            self._write(merged, "state", PART, version, attempt)
            self._write_directory("state", PART, merged.select(PART), parts, before, version, attempt)
        row = self.spark.createDataFrame([(version, attempt)], "version int, attempt string")
        row.coalesce(1).write.mode("append").parquet(f"{self.folder}/manifest")
        return version

    def _period(self) -> Column:
        return F.col(DAY) if self.period == "day" else F.trunc(DAY, self.period)

    def _delta(self, new: DataFrame, old: DataFrame) -> DataFrame:
        """Per state key what to add, with the days to add and to remove."""
        main = F.coalesce(F.col("amount.main").cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
        day = F.struct(F.col(DAY).alias("day"), F.coalesce("amount.rest", F.lit(0.0)).alias("rest"))
        signs = new.withColumn("sign", F.lit(1)).unionByName(old.withColumn("sign", F.lit(-1)))
        return (
            signs.groupBy(*STATE_KEYS)
            .agg(
                F.sum(F.when(F.col("sign") > 0, main).otherwise(-main)).cast("decimal(38,0)").alias("main"),
                F.sum(F.col("n") * F.col("sign")).alias("n"),
                F.sum(F.col("n_amount") * F.col("sign")).alias("n_amount"),
                # At most the touched days, each once.
                F.collect_list(F.when(F.col("sign") > 0, day)).cast(DAYS).alias("days"),
                F.collect_list(F.when(F.col("sign") < 0, day)).cast(DAYS).alias("gone"),
            )
            .withColumn(PART, F.pmod(F.xxhash64("org_id"), F.lit(self.parts)).cast("int"))
        )

    def _merged(self, state: DataFrame, delta: DataFrame) -> DataFrame:
        """The touched parts' state with the delta applied; keys without rows go."""
        none = F.array().cast(DAYS)
        both = state.select(*STATE_KEYS, PART, *MEASURES, F.col("days").alias("had"), none.alias("days"), none.alias("gone"))
        both = both.unionByName(delta.withColumn("had", none))
        # One row of the state and one of the delta a key, so these lists hold two arrays.
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("had", "days", "gone")]
        sums = [F.sum("main").cast("decimal(38,0)").alias("main"), F.sum("n").alias("n"), F.sum("n_amount").alias("n_amount")]
        left = F.filter("had", lambda h: ~F.exists("gone", lambda g: g["day"].eqNullSafe(h["day"])))
        days = F.array_sort(F.concat(left, "days"))
        return both.groupBy(*STATE_KEYS, PART).agg(*sums, *lists).where("n > 0").select(*STATE_KEYS, *MEASURES, days.alias("days"), PART)

    # --- generations --------------------------------------------------------

    def _write(self, rows: DataFrame, table: str, key: str, version: int, attempt: str) -> None:
        # Rebalanced by the key: few files a folder, and a large folder is split over tasks.
        rows.hint("rebalance", F.col(key)).write.partitionBy(key).parquet(f"{self.folder}/{table}/{GENERATION}={version}-{attempt}")

    def _write_directory(
        self, table: str, key: str, present: DataFrame, touched: DataFrame, before: int, version: int, attempt: str
    ) -> None:
        """Name the generation of every period or part: the old one, but for the touched."""
        gone = touched.withColumnRenamed(key, "_key")
        stay = self._directory(table, key, before).join(gone, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
        mine = present.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).withColumn(GENERATION, F.lit(f"{version}-{attempt}"))
        stay.unionByName(mine).coalesce(1).write.parquet(f"{self.folder}/{table}_directory/{version}-{attempt}")

    def _manifest(self) -> DataFrame:
        schema = "version int, attempt string"
        if not self._exists("manifest"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/manifest")

    def _directory(self, table: str, key: str, version: int) -> DataFrame:
        """(key, rows, generation) of a version; one row a period or part."""
        schema = f"{key} {'date' if key == PERIOD else 'int'}, rows long, {GENERATION} string"
        if not version:
            return self.spark.createDataFrame([], schema)
        found = self._manifest().where(F.col("version") == version).agg(F.min("attempt")).first()[0]
        if found is None:
            raise KeyError(f"no version {version}")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}_directory/{version}-{found}")

    def _current(self, table: str, key: str, kind: str, version: int | None) -> DataFrame:
        """The rows of the generations that a version's directory names.

        Generation and key are partition folders. The condition on ``rows``
        makes Spark prune folders by the joined directory before it reads.
        """
        version = self.version() if version is None else version
        stored = "org_id string, user_id string, action string, credit_type string, n long, n_amount long, "
        stored += f"main decimal(38,0), days {DAYS}" if table == "state" else f"{DAY} date, amount {AMOUNT}"
        schema = f"{stored}, {GENERATION} string, {key} {kind}"
        if not version:
            return self.spark.createDataFrame([], schema)
        named = self._directory(table, key, version).where("rows > 0").select(F.col(key).alias("_key"), F.col(GENERATION).alias("_of"))
        rows = self.spark.read.schema(schema).parquet(f"{self.folder}/{table}")
        on = (F.col(GENERATION) == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key"))
        return rows.join(named, on).drop("_key", "_of")

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)


def incremental_marts(
    spark: SparkSession, folder: str | None = None, parts: int = 64, period: str = "day"
) -> IncrementalMarts:
    """Open (or begin) the tables in ``folder``; default: a new one in the shared stage folder.

    ``parts`` and ``period`` ("day", "month", "quarter" or "year") belong to the
    tables: open a folder with the ones it began with.
    """
    if period not in ("day", "month", "quarter", "year"):
        raise ValueError(f"unknown period {period!r}")
    folder = folder or f"{checkpoint_dir(spark).rstrip('/')}/creditlake-marts-{uuid.uuid4().hex}"
    return IncrementalMarts(spark, folder, parts, period)
