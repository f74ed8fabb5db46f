from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from creditlake.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="creditlake-tests-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    session = build_session(
        "local[4]",
        app_name="creditlake-tests",
        shuffle_partitions=4,
        conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
        },
    )
    yield session
    session.stop()


RAW_DDL = (
    "org_id string, user_id string, credit_type string, action string, "
    "credits string, timestamp string, seq bigint"
)
FACT_DDL = (
    "org_id string, user_id string, credit_type string, action string, credits double, timestamp timestamp"
)
ORGS_DDL = "org_id string, org_name string, industry string"
USERS_DDL = "user_id string, user_name string, email string, org_id string, role string"


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def raw_rows(spark, rows):
    """Raw text rows (org, user, type, action, credits, timestamp); seq = position."""
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RAW_DDL)


def fact_rows(spark, rows):
    """Clean fact rows (org, user, type, action, credits, 'YYYY-MM-DD[ HH:MM:SS]')."""
    out = []
    for org, user, ctype, action, credits, when in rows:
        stamp = ts(when if " " in when else when + " 00:00:00") if when else None
        out.append((org, user, ctype, action, credits, stamp))
    return spark.createDataFrame(out, FACT_DDL)


def by_key(rows, key):
    return {getattr(r, key): r for r in rows}
