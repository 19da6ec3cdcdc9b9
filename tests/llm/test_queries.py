"""Registered text queries: names, SQL where there is one, a session-free import."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from kohorta.llm import queries

ROOT = Path(__file__).resolve().parent.parent.parent
FOLDER = "/root/testdata/sf0.001"


def test_names():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}


def test_import_needs_no_session():
    code = "import __spark_entry__ as e; assert 'pipeline' in e.queries() and e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = queries.QUERIES[name](spark, FOLDER)
    want = con.sql(queries.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    names = sorted(df.columns)
    got = sorted(tuple(str(r[n]) for n in names) for r in df.collect())
    place = [want.columns.index(n) for n in names]
    assert got == sorted(tuple(str(r[i]) for i in place) for r in want.fetchall())
