"""mixed-format timestamp parsing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from creditlake.functions.timestamps import parse_mixed_timestamp
from conftest import ts

CASES = [
    # ISO text
    ("2024-11-24 00:00:00", ts("2024-11-24 00:00:00")),
    ("2024-1-5 3:4:5", ts("2024-01-05 03:04:05")),
    ("2024-02-30 00:00:00", None),
    (" 2024-11-24 00:00:00", None),
    ("2024-11-24  00:00:00", ts("2024-11-24 00:00:00")),  # a format space matches a run of whitespace
    ("2024-11-24\t00:00:00", ts("2024-11-24 00:00:00")),
    ("2024-11-24 00:00:00 ", None),
    ("2024-11-24", None),
    # European text, one- and two-digit day
    ("19-12-2024", ts("2024-12-19 00:00:00")),
    ("5-1-2024", ts("2024-01-05 00:00:00")),
    # US text: the marker is required but does not change the hour
    ("10/29/2024 12:00 AM", ts("2024-10-29 12:00:00")),
    ("01/02/2024 02:30 PM", ts("2024-01-02 02:30:00")),
    ("01/02/2024 12:00 AM", ts("2024-01-02 12:00:00")),
    ("1/2/2024 14:05 pm", ts("2024-01-02 14:05:00")),
    ("10/29/2024 14:00", None),
    ("01/02/2024  02:30\tPM", ts("2024-01-02 02:30:00")),
    # epoch seconds inside the closed range 1990-01-01 .. 2050-01-01
    ("1700000000", ts("2023-11-14 22:13:20")),
    ("1700000000.5", ts("2023-11-14 22:13:20.500000")),
    ("631152000", ts("1990-01-01 00:00:00")),
    ("2524608000", ts("2050-01-01 00:00:00")),
    ("631151999", None),
    ("2524608001", None),
    ("1731542400000", None),
    ("1e9", ts("2001-09-09 01:46:40")),
    (" 1700000000 ", ts("2023-11-14 22:13:20")),
    (" 12 ", None),  # a number, but 1970 is outside the epoch range
    # not numbers, not dates
    ("12d", None),
    ("inf", None),
    ("not-a-date", None),
    ("", None),
    (None, None),
]


def test_parse_mixed_timestamp(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(CASES)], "i int, s string")
    got = {r.i: r.t for r in df.select("i", parse_mixed_timestamp(F.col("s")).alias("t")).collect()}
    for i, (text, want) in enumerate(CASES):
        assert got[i] == want, f"{text!r}: {got[i]} != {want}"


def test_parse_honours_meridiem_when_asked(spark):
    df = spark.createDataFrame([("01/02/2024 02:30 PM",), ("01/02/2024 12:00 AM",)], "s string")
    got = [r.t for r in df.select(parse_mixed_timestamp("s", meridiem="honour").alias("t")).collect()]
    assert got == [ts("2024-01-02 14:30:00"), ts("2024-01-02 00:00:00")]


def test_parse_rejects_unknown_mode():
    with pytest.raises(ValueError):
        parse_mixed_timestamp("s", meridiem="guess")


def test_parse_plan_has_no_python_udf(spark):
    df = spark.createDataFrame([("1700000000",)], "s string").select(parse_mixed_timestamp("s"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
