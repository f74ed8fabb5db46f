"""S1 CSV scan, S3/S10 publish with checks and swap, and the end-to-end run()."""

from __future__ import annotations

import os

import pytest

from creditlake.operators import marts as M
from creditlake.operators.clean import clean, cleaning_report
from creditlake.operators.quality import DataQualityError
from creditlake.plans.publish import MART_NAMES, publish, publish_marts, refresh_marts, run
from creditlake.sources.csv import read_raw_actions
from creditlake.sources.tables import read_table
from conftest import ORGS_DDL, USERS_DDL, fact_rows

CSV = '''org_id,user_id,credit_type,action,credits,timestamp,notes
org_1,user_1,Type_A,add,10,2024-01-05 10:00:00,"a ""quoted"", note"
 ORG_1 ,user_1,NA,deduct,n/a,07-01-2024,x
org_1,user_1,,DEDUCT ,2.5,01/06/2024 02:30 PM,
org_2,user_1,type_a,add,1,1704758400,
NULL,user_2,type_b,add,3,null,
org_2,user_2,type_b,deduct,1,2024-01-07 00:00:00,
org_2,,type_b,add,1,2024-01-07 00:00:00,
'''


@pytest.fixture()
def csv_path(scratch):
    folder = os.path.join(scratch, "csv")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "actions.csv")
    with open(path, "w") as fh:
        fh.write(CSV)
    return path


def test_csv_scan_reads_text_and_nulls_tokens(spark, csv_path):
    raw = read_raw_actions(spark, csv_path)
    assert raw.columns == ["org_id", "user_id", "credit_type", "action", "credits", "timestamp", "seq"]
    rows = raw.orderBy("seq").collect()
    assert len(rows) == 7
    assert rows[0].timestamp == "2024-01-05 10:00:00"  # the quoted note did not shift columns
    assert rows[1].org_id == " ORG_1 " and rows[1].credit_type is None and rows[1].credits is None
    assert rows[2].credit_type is None and rows[4].org_id is None and rows[4].timestamp is None


def test_clean_from_csv(spark, csv_path):
    out = sorted(
        (r.org_id, r.user_id, r.credit_type, r.action, r.credits, str(r.timestamp))
        for r in clean(read_raw_actions(spark, csv_path)).collect()
    )
    assert out == [
        ("org_1", "user_1", "default", "deduct", 2.5, "2024-01-06 02:30:00"),
        ("org_1", "user_1", "type_a", "add", 10.0, "2024-01-05 10:00:00"),
        ("org_2", "user_2", "type_b", "deduct", 1.0, "2024-01-07 00:00:00"),
    ]


def test_publish_checks_before_swap(spark):
    ddl = "org_id string, total_credits double"
    publish(spark, spark.createDataFrame([("o1", 1.0)], ddl), "t_publish", unique_keys=("org_id",))
    reader = spark.table("t_publish")  # a query resolved against the first version
    bad = spark.createDataFrame([("o1", 1.0), ("o1", 2.0)], ddl)
    with pytest.raises(DataQualityError):
        publish(spark, bad, "t_publish", unique_keys=("org_id",))
    assert [tuple(r) for r in spark.table("t_publish").collect()] == [("o1", 1.0)]
    publish(spark, spark.createDataFrame([("o1", 2.0)], ddl), "t_publish", unique_keys=("org_id",))
    assert [tuple(r) for r in reader.collect()] == [("o1", 1.0)]  # previous version still readable
    publish(spark, spark.createDataFrame([("o1", 3.0)], ddl), "t_publish", unique_keys=("org_id",))
    assert [tuple(r) for r in spark.table("t_publish").collect()] == [("o1", 3.0)]
    assert spark.catalog.getTable("t_publish").tableType == "VIEW"
    versions = [t.name for t in spark.catalog.listTables() if t.name.startswith("t_publish__v")]
    assert len(versions) == 2  # current + previous; the first and the failed one are gone


def test_run_end_to_end(spark, csv_path):
    orgs = spark.createDataFrame([("org_1", "One", "Tech"), ("org_2", "Two", "Retail")], ORGS_DDL)
    users = spark.createDataFrame(
        [("user_1", "Ann", "a@x", "org_1", "admin"), ("user_2", "Bob", "b@x", "org_2", "user")], USERS_DDL
    )
    def stages():
        if not spark.catalog.databaseExists("creditlake_stages"):
            return set()
        return {t.name for t in spark.catalog.listTables(dbName="creditlake_stages")}

    before = stages()
    result = run(spark, csv_path, orgs, users, as_of="2024-01-31")
    assert stages() == before  # the cleaning stage was dropped after the fact was published
    counted = cleaning_report(read_raw_actions(spark, csv_path)).first().asDict()
    assert {k: result.cleaning[k] for k in counted} == counted
    report = {r.table_name: (r.total_records, r.verdict) for r in result.report.collect()}
    assert report["user_actions"] == (3, "low_count")
    assert set(report) == {"user_actions", *MART_NAMES}
    fact = read_table(spark, "user_actions")  # S5: full scan of a published table
    assert fact.count() == 3
    direct = M.executive_summary(fact, spark.table("organizations"), spark.table("users"))
    assert sorted(spark.table("executive_summary_view").collect()) == sorted(direct.collect())
    finance = {r.org_id: r.net_credit_balance for r in spark.table("enhanced_finance_view").collect()}
    assert finance == {"org_1": 7.5, "org_2": -1.0}


def test_publish_rejects_nulls_counted_during_the_write(spark):
    ddl = "org_id string, user_id string"
    publish(spark, spark.createDataFrame([("o1", "u1")], ddl), "t_not_null", not_null=("org_id", "user_id"))
    bad = spark.createDataFrame([("o1", None), (None, None)], ddl)
    with pytest.raises(DataQualityError, match="user_id"):
        publish(spark, bad, "t_not_null", not_null=("org_id", "user_id"))
    assert [tuple(r) for r in spark.table("t_not_null").collect()] == [("o1", "u1")]
    assert len([t for t in spark.catalog.listTables() if t.name.startswith("t_not_null__v")]) == 1


def test_refresh_marts_recomputes_from_the_published_fact(spark, csv_path):
    orgs = spark.createDataFrame([("org_1", "One", "Tech"), ("org_2", "Two", "Retail")], ORGS_DDL)
    users = spark.createDataFrame(
        [("user_1", "Ann", "a@x", "org_1", "admin"), ("user_2", "Bob", "b@x", "org_2", "user")], USERS_DDL
    )
    run(spark, csv_path, orgs, users, as_of="2024-01-31")
    before = {r.org_id: r.total_credits for r in spark.table("finance_org_credit_balance").collect()}
    # a correction lands in the fact table: one more purchase for org_2
    extra = spark.createDataFrame(
        [("org_2", "user_2", "type_b", "add", 4.0, None)],
        "org_id string, user_id string, credit_type string, action string, credits double, timestamp timestamp",
    )
    publish(spark, spark.table("user_actions").unionByName(extra), "user_actions")
    refreshed = refresh_marts(spark, ["finance_org_credit_balance"], as_of="2024-01-31")
    after = {r.org_id: r.total_credits for r in refreshed["finance_org_credit_balance"].collect()}
    assert after == {**before, "org_2": before["org_2"] + 4.0}
    with pytest.raises(ValueError):
        refresh_marts(spark, ["no_such_mart"])


def test_served_columns_must_not_be_null(spark):
    """A NULL that a served row may not have fails the publish and leaves the old version."""
    rows = [("o1", "u1", "t", "add", 2.0, "2024-01-02"), ("o2", "u1", "t", "add", 1.0, "2024-01-03")]
    fact = fact_rows(spark, rows)
    good = M.finance_mart(fact, spark.createDataFrame([("o1", "One", "Tech")], ORGS_DDL))
    bad = M.finance_mart(fact, spark.createDataFrame([("o1", "One", "Tech"), ("o2", "Two", None)], ORGS_DDL))
    publish_marts(spark, {"enhanced_finance_view": good})
    with pytest.raises(DataQualityError, match="industry"):
        publish_marts(spark, {"enhanced_finance_view": bad})
    assert [r.org_id for r in spark.table("enhanced_finance_view").collect()] == ["o1"]
    publish_marts(spark, {"enhanced_finance_view": bad}, strict_nulls=False)
    assert spark.table("enhanced_finance_view").count() == 2
    users = spark.createDataFrame([("u1", "Ann", "a@x", "o1", "admin")], USERS_DDL)
    no_usage = M.cs_user_mart(fact.withColumn("timestamp", fact.timestamp), spark.createDataFrame([("o1", "One", "Tech")], ORGS_DDL), users, "2024-01-31")
    publish_marts(spark, {"enhanced_customer_success_view": no_usage})
    assert spark.table("enhanced_customer_success_view").count() == 1
