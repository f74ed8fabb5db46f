"""Bindings of the ledger contracts onto the driver's parquet tables.

B1 (orders): the fact is ``orders`` joined to ``customer`` for the home
organisation; organisations come from ``nation`` + ``region``, users from
``customer``. B2 (events): the fact is ``events`` folded onto 20 users (customer keys 0-19)
and 10 organisations (nation keys 0-9); the dimensions are the same whole
tables as in B1. B2m: B2 rendered as the messy raw text a CSV export would
hold, to drive the cleaning step. B3: raw rows from ``orders`` with one user who
has a third of them. Every binding reads whole tables, so its work
grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditlake.sources.dimensions import organizations_from, users_from
from creditlake.sources.tables import read_parquet_table

# Reporting dates of each binding (the last activity date in its data).
B1_AS_OF = "2001-08-01"
B2_AS_OF = "2024-01-30"

# Fixed values of the bindings' folding rules.
B2_USERS = 20
B2_ORGS = 10
B1_DEFAULT_PRIORITY = "4-NOT SPECIFIED"


class Ledger:
    """A fact table with its two dimensions and its reporting date.

    Dimensions are built on first use, so a query that needs only the fact
    never plans the dimension scans.
    """

    def __init__(
        self,
        actions: DataFrame,
        organizations: Callable[[], DataFrame],
        users: Callable[[], DataFrame],
        as_of: str,
    ) -> None:
        self.actions = actions
        self._organizations = organizations
        self._users = users
        self.as_of = as_of

    @cached_property
    def organizations(self) -> DataFrame:
        return self._organizations()

    @cached_property
    def users(self) -> DataFrame:
        return self._users()


def org_key(nation_key: Column) -> Column:
    return F.concat(F.lit("org_"), F.lpad(nation_key.cast("string"), 3, "0"))


def user_key(customer_key: Column) -> Column:
    return F.concat(F.lit("user_"), customer_key.cast("string"))


def _organizations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_parquet_table(spark, sf_dir, "nation")
    region = read_parquet_table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    return organizations_from(
        joined, org_id=org_key(F.col("n_nationkey")), org_name="n_name", industry="r_name"
    )


def _users(customer: DataFrame) -> DataFrame:
    return users_from(
        customer,
        user_id=user_key(F.col("c_custkey")),
        user_name="c_name",
        email=F.concat(F.lower(F.col("c_name")), F.lit("@example.com")),
        org_id=org_key(F.col("c_nationkey")),
        role="c_mktsegment",
    )


def orders_ledger(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> Ledger:
    """B1: one action per order, organisation = the customer's nation."""
    orders = read_parquet_table(spark, sf_dir, "orders")
    customer = read_parquet_table(spark, sf_dir, "customer")
    fact = orders.join(
        customer.select("c_custkey", "c_nationkey"),
        orders.o_custkey == customer.c_custkey,
        "inner",
    )
    cols = [
        org_key(F.col("c_nationkey")).alias("org_id"),
        user_key(F.col("o_custkey")).alias("user_id"),
        F.when(F.col("o_orderpriority") == B1_DEFAULT_PRIORITY, F.lit("default"))
        .otherwise(F.lower("o_orderpriority"))
        .alias("credit_type"),
        F.when(F.col("o_orderstatus") == "F", F.lit("add"))
        .when(F.col("o_orderstatus") == "O", F.lit("deduct"))
        .when(F.col("o_orderstatus") == "P", F.lit("p"))
        .alias("action"),
        F.col("o_totalprice").cast("double").alias("credits"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"),
    ]
    if with_seq:
        cols.append(F.col("o_orderkey").alias("seq"))
    return Ledger(
        fact.select(*cols),
        lambda: _organizations(spark, sf_dir),
        lambda: _users(customer),
        B1_AS_OF,
    )


def _event_user(events_user_id: Column) -> Column:
    return events_user_id % B2_USERS


def _event_k(props: Column) -> Column:
    """The integer ``k`` of the events' ``{"k": n}`` props (a regex: JSON parsing is ~10x dearer)."""
    return F.regexp_extract(props, r'"k"\s*:\s*(-?\d+)', 1).try_cast("int")


def events_ledger(spark: SparkSession, sf_dir: str, with_seq: bool = False) -> Ledger:
    """B2: 20 users, two per organisation; action and credit type from the event."""
    events = read_parquet_table(spark, sf_dir, "events")
    u = _event_user(F.col("user_id"))
    k = _event_k(F.col("props"))
    cols = [
        org_key(F.floor(u / 2)).alias("org_id"),
        user_key(u).alias("user_id"),
        F.when(k % 10 == 0, F.lit("default"))
        .otherwise(F.concat(F.lit("type_"), (k % 2).cast("string")))
        .alias("credit_type"),
        F.when(F.col("event_type") == "purchase", F.lit("add"))
        .when(F.col("event_type").isin("click", "view"), F.lit("deduct"))
        .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
        .otherwise(F.col("event_type"))
        .alias("action"),
        F.col("value").cast("double").alias("credits"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    ]
    if with_seq:
        cols.append(F.col("event_id").alias("seq"))
    return Ledger(
        events.select(*cols),
        lambda: _organizations(spark, sf_dir),
        lambda: _users(read_parquet_table(spark, sf_dir, "customer")),
        B2_AS_OF,
    )


def messy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2m: raw text rows (org_id, user_id, credit_type, action, credits, timestamp, seq).

    Padding, case, NULLs, a second organisation for some users and seven
    timestamp shapes are derived from ``event_id`` so both engines build the
    same rows.
    """
    events = read_parquet_table(spark, sf_dir, "events")
    e = F.col("event_id")
    u = _event_user(F.col("user_id"))
    k = _event_k(F.col("props"))
    org_num = (F.floor(u / 2) + F.when(e % 11 == 0, 1).otherwise(0)) % B2_ORGS
    org = org_key(org_num)
    user = user_key(u)
    ts = F.col("ts").cast("timestamp")
    hour_marker = F.when(F.hour(ts) < 12, F.lit(" AM")).otherwise(F.lit(" PM"))
    shape = e % 7
    null = F.lit(None).cast("string")
    return events.select(
        F.when(e % 13 == 0, null)
        .when(e % 7 == 0, F.concat(F.lit(" "), F.upper(org), F.lit(" ")))
        .otherwise(org)
        .alias("org_id"),
        F.when(e % 17 == 0, null)
        .when(e % 29 == 0, F.concat(user, F.lit(" ")))
        .otherwise(user)
        .alias("user_id"),
        F.when(e % 23 == 0, null)
        .when(k % 10 == 0, F.lit(" Default"))
        .otherwise(F.concat(F.lit("Type_"), (k % 2).cast("string")))
        .alias("credit_type"),
        F.when(F.col("event_type") == "purchase", F.lit("ADD "))
        .when(F.col("event_type") == "click", F.lit("deduct"))
        .when(F.col("event_type") == "view", F.lit(" Deduct"))
        .when(F.col("event_type") == "signup", null)
        .otherwise(F.col("event_type"))
        .alias("action"),
        F.when(e % 19 == 0, null).otherwise(F.col("value").cast("string")).alias("credits"),
        F.when(shape == 0, F.unix_seconds(ts).cast("string"))
        .when(shape == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(shape == 2, F.date_format(ts, "dd-MM-yyyy"))
        .when(shape == 3, F.concat(F.date_format(ts, "MM/dd/yyyy HH:mm"), hour_marker))
        .when(shape == 4, F.lit("not-a-date"))
        .when(shape == 5, null)
        .otherwise(F.lit("1731542400000"))
        .alias("timestamp"),
        e.alias("seq"),
    )


def messy_events_ledger(spark: SparkSession, sf_dir: str) -> Ledger:
    """B2m raw rows with the B2 dimensions (fact still needs cleaning)."""
    dims = events_ledger(spark, sf_dir)
    return Ledger(messy_events(spark, sf_dir), lambda: dims.organizations, lambda: dims.users, B2_AS_OF)


def hot_user_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows from orders, users growing with the data; one user holds a third of all rows."""
    orders = read_parquet_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return orders.select(
        org_key(k % 7).alias("org_id"),
        F.when(k % 3 == 0, user_key(F.lit(0))).otherwise(user_key(F.col("o_custkey"))).alias("user_id"),
        F.lower("o_orderpriority").alias("credit_type"),
        F.when(F.col("o_orderstatus") == "F", F.lit("add")).otherwise(F.lit("deduct")).alias("action"),
        F.col("o_totalprice").cast("string").alias("credits"),
        F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        k.alias("seq"),
    )
