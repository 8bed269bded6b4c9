"""Every registered query with SQL against DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from snapstats.llm.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def tables(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, small, tables, name):
    got, want = QUERIES[name](spark, small), tables.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want.select(*(f'"{c}"' for c in columns)).fetchall(), key=repr)


def test_entry_has_them_all():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
