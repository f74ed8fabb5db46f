"""Quality checks Q1-Q5 and exploration A20-A21."""

from __future__ import annotations

import pytest

from creditlake.operators import explore as X
from creditlake.operators import quality as Q
from creditlake.schemas import FINANCE_ORG_BALANCE
from conftest import USERS_DDL


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    assert [tuple(r) for r in Q.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    assert Q.duplicate_keys(df, ["k", "v"]).collect() == []


def test_table_check_verdicts(spark):
    empty = spark.createDataFrame([], "x int")
    few = spark.range(3)
    many = spark.range(10)
    got = {r.table_name: (r.total_records, r.verdict) for r in Q.table_check({"e": empty, "f": few, "m": many}).collect()}
    assert got == {"e": (0, "empty"), "f": (3, "low_count"), "m": (10, "passed")}


def test_null_and_key_violations(spark):
    users = spark.createDataFrame(
        [("u1", "Ann", None, "o1", None), ("u1", None, None, "o1", None), (None, "Cid", None, "o9", None)],
        USERS_DDL,
    )
    got = {
        (r.check_name, r.column_name): r.violations
        for r in Q.null_violations("users", users, ["user_id", "user_name"], ["user_id"]).collect()
    }
    assert got == {("not_null", "user_id"): 1, ("not_null", "user_name"): 1, ("primary_key", "user_id"): 1}
    with pytest.raises(Q.DataQualityError):
        Q.assert_clean(Q.null_violations("users", users, ["user_name"]), "users")
    clean = users.where("user_id = 'u1' and user_name is not null")
    Q.assert_clean(Q.null_violations("users", clean, ["user_id", "user_name"], ["user_id"]), "users")


def test_orphan_users(spark):
    users = spark.createDataFrame(
        [("u1", "Ann", None, "o1", None), ("u2", "Bob", None, "o9", None), ("u3", "Cid", None, None, None)],
        USERS_DDL,
    )
    orgs = spark.createDataFrame([("o1",)], "org_id string")
    assert [r.user_id for r in Q.orphan_users(users, orgs).collect()] == ["u2"]


def test_schema_mismatches(spark):
    good = spark.createDataFrame([("o1", 1.0)], "org_id string, total_credits double")
    assert Q.schema_mismatches(good, FINANCE_ORG_BALANCE) == []
    bad = spark.createDataFrame([(1.0, "o1")], "total_credits double, org_id string")
    assert Q.schema_mismatches(bad, FINANCE_ORG_BALANCE)
    with pytest.raises(Q.DataQualityError):
        Q.assert_schema(bad, FINANCE_ORG_BALANCE, "finance")


def test_distinct_ids_and_dedup(spark):
    ddl = "org_id string, user_id string, credit_type string, action string, credits double, timestamp string, seq bigint"
    rows = [
        ("o1", "u1", "t", "add", 1.0, "2024", 2),
        ("o1", "u1", "t", "deduct", 2.0, "2024", 1),
        ("o1", None, "t", "add", 3.0, "2024", 3),
        ("o2", "u2", None, "add", 4.0, None, 4),
        ("o2", "u2", None, "add", 5.0, None, 5),
    ]
    df = spark.createDataFrame(rows, ddl)
    ids = sorted((r.id_column, r.id_value) for r in X.distinct_ids(df).collect() if r.id_value)
    assert ids == [("org_id", "o1"), ("org_id", "o2"), ("user_id", "u1"), ("user_id", "u2")]
    counts = {r.id_column: r.n_distinct for r in X.distinct_id_counts(df).collect()}
    assert counts == {"org_id": 2, "user_id": 3}  # NULL counts as a value
    kept = sorted((r.seq, r.action) for r in X.dedup_actions(df).collect())
    assert kept == [(1, "deduct"), (3, "add"), (4, "add")]
    assert X.dedup_actions(df).columns == df.columns
