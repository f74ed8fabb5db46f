"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("region", "nation", "customer", "orders", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{name}.parquet')")
    return con


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if isinstance(v, float) and math.isnan(v):
                v = "nan"
            vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "organization" in df.columns


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    spark_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    duck_cols = [c[0] for c in res.description]
    duck_rows = res.fetchall()
    assert sorted(df.columns) == sorted(duck_cols)
    assert _canon(df.columns, spark_rows) == _canon(duck_cols, duck_rows)
