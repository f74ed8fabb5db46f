"""CSV files: headers that differ, records that span lines and blocks, rows of a wrong width."""

from __future__ import annotations

import csv
import random

import pytest

from creditlake.schemas import FACT_COLUMNS
from creditlake.sources.csv import read_raw_actions, scan_actions

HEADER = "org_id,user_id,credit_type,action,credits,timestamp\n"


def written(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text, newline="")
    return str(folder)


def in_order(df):
    return [tuple(r[c] for c in FACT_COLUMNS) for r in df.orderBy("seq").collect()]


@pytest.fixture()
def small_blocks(spark):
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", saved)


def test_each_file_goes_by_its_own_header(spark, tmp_path):
    path = written(
        tmp_path / "in",
        a=HEADER + "o1,u1,t,add,1,2024-01-01\n",
        b="timestamp,notes,credits,action,user_id,org_id\n2024-01-02,\"x, y\",2,deduct,u2,o2\n",
        c=HEADER + "o3,u3,t,add,3,2024-01-03\n",
        d="",
    )
    assert in_order(read_raw_actions(spark, path)) == [
        ("o1", "u1", "t", "add", "1", "2024-01-01"),
        ("o2", "u2", None, "deduct", "2", "2024-01-02"),
        ("o3", "u3", "t", "add", "3", "2024-01-03"),
    ]


@pytest.mark.parametrize("block", [64, 200, 1000, 10_000_000])
def test_records_across_lines_and_blocks(spark, tmp_path, small_blocks, block):
    """Whatever the blocks, the rows are those of a sequential reader."""
    rng = random.Random(block)
    rows = []
    for i in range(120):
        kind = rng.choice(["plain", "two\nlines", "a \"quoted\" one", "three\n\nparts, with commas\n", "\n", "x" * rng.randint(1, 150) + "\n" + "y" * 90])
        rows.append((f"o{i}", f"u{i}", kind, rng.choice(["add", "line\nend"]), str(i), "2024-01-01 00:00:00"))
    folder = tmp_path / "in"
    folder.mkdir()
    with open(folder / "a.csv", "w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([HEADER.strip().split(","), *rows])
    written(folder, b=HEADER + "o,u,t,add,1,2024\n" * 30)
    small_blocks(block)
    assert in_order(read_raw_actions(spark, str(folder))) == rows + [("o", "u", "t", "add", "1", "2024")] * 30


def test_report_of_odd_rows(spark, tmp_path):
    path = written(
        tmp_path / "in",
        a=HEADER + "o1,u1,t,add,1,2024-01-01\no1,u1\n\no2,u2,t,add,1,2024-01-01,more,\"and, more\"\n",
        b=HEADER + 'o3,u3,"t\nt",add,1\n',
        c=HEADER + 'o4,u4,"open,add,1,x\no5,u5,t,add,1,2024-01-01\n',
    )
    scan = scan_actions(spark, path)
    report = {r["file"][-5]: (r["records"], r["short_rows"], r["long_rows"], r["unbalanced"]) for r in scan.report().collect()}
    assert report["a"] == (3, 1, 1, False)
    assert report["b"] == (1, 1, 0, False)
    assert report["c"][0] == 2 and report["c"][3]
    rows = in_order(scan.rows)
    assert rows[1] == ("o1", "u1", None, None, None, None)
    assert rows[2] == ("o2", "u2", "t", "add", "1", "2024-01-01")
    assert rows[3] == ("o3", "u3", "t\nt", "add", "1", None)
    assert rows[5][:2] == ("o5", "u5")  # the file with an open quote is read line by line


def test_no_rows(spark, tmp_path):
    assert read_raw_actions(spark, written(tmp_path / "in", a="")).collect() == []
    assert read_raw_actions(spark, written(tmp_path / "two", a=HEADER)).collect() == []
