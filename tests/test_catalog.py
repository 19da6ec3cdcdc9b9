"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402
from kohorta import catalog  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# The text operators have their own tests.
QUERIES = catalog.QUERIES
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert got
        return
    want = duck.sql(ORACLES[name])
    assert rows_of(df.columns, got) == rows_of(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
