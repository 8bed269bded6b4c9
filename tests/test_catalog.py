"""Every registered query against its SQL on DuckDB, and the shape of its plan."""

import math
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry
import skewed
from snapstats.catalog import ORACLE, QUERIES


# Queries whose plan depends on how rows spread over keys.
SKEW_SENSITIVE = (
    "rates_snapshot", "transform_countries", "map_values_table", "fill_rates_median", "country_history_long",
    "dedup_keys", "dedup_rows", "duplicate_stats", "upsert_latest", "daily_change", "rolling7", "date_gaps", "ranks",
    "top_affected", "q_completeness_major", "q_historical_vs_current", "m_metric_days", "validate", "iqr_outliers",
)


def _duck(folder):
    con = duckdb.connect()
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{folder}/{name}'")
    return con


@pytest.fixture(scope="module")
def duck(small):
    return _duck(small)


@pytest.fixture(scope="module")
def skewed_tables(small, tmp_path_factory):
    return skewed.write(small, tmp_path_factory.mktemp("skewed"))


@pytest.fixture(scope="module")
def skewed_duck(skewed_tables):
    return _duck(skewed_tables)


def _sort_key(row):
    return tuple((v is None, isinstance(v, str), v if v is not None else 0) for v in row)


def _same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return a == b


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, small, name):
    check(spark, duck, small, name)


@pytest.mark.parametrize("name", SKEW_SENSITIVE)
def test_query_on_skewed_tables(spark, skewed_duck, skewed_tables, name):
    check(spark, skewed_duck, skewed_tables, name)


def check(spark, duck, folder, name):
    df = QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas", plan)
    columns = sorted(df.columns)
    rows = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=_sort_key)
    assert rows or name in {"missing_dates"}
    if name not in ORACLE:
        return
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=_sort_key)
    assert len(rows) == len(expected)
    for got, want in zip(rows, expected):
        assert all(_same(a, b) for a, b in zip(got, want)), (got, want)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert entry.entry(spark).columns[:3] == ["country", "continent", "cases"]
