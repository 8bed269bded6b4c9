import uuid

import pytest
from pyspark.sql import functions as F

from snapstats import bind
from snapstats.catalog import QUERIES
from snapstats.operators import series
from snapstats.sources import writers


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _name():
    return f"t{uuid.uuid4().hex}"


def test_windows_over_created_tables_need_no_shuffle(spark, small):
    assert "Exchange" not in _plan(QUERIES["bucketed_daily_change"](spark, small))


def test_joins_of_buckets_need_no_shuffle(spark, small):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES["bucketed_join"](spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_one_file_a_bucket_saves_the_sort(spark, small):
    stored = writers.store_bucketed(bind.history(spark, small), _name(), ["country", "metric"], 3, ["date"])
    assert len(stored.inputFiles()) <= 3
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, bind.history(spark, small).collect()))
    assert "Exchange" not in _plan(series.with_daily_change(stored))


def test_null_keys_ties_and_no_rows(spark):
    rows = spark.createDataFrame([(None, 1), (None, 1), ("a", 2), ("a", 2), ("", 3)], "k STRING, v INT")
    stored = writers.store_bucketed(rows, _name(), ["k"], 4, ["v"])
    assert sorted(map(str, stored.collect())) == sorted(map(str, rows.collect()))
    assert writers.store_bucketed(rows.limit(0), _name(), ["k"], 4).count() == 0


def test_loads_append_to_the_buckets(spark, small):
    prefix = _name()
    assert writers.create_tables(spark, ("historical",), prefix, buckets=5) == {f"{prefix}historical": None}
    assert writers.bucketing(spark, f"{prefix}historical") == (5, ["country", "metric"])
    rows = bind.history(spark, small)
    for _ in range(2):
        assert writers.load_tables({"historical": rows}, prefix) == {f"{prefix}historical": None}
    table = spark.table(f"{prefix}historical")
    assert table.count() == 2 * rows.count()
    counted = table.groupBy("country", "metric").agg(F.count(F.lit(1)).alias("n"))
    assert "Exchange" not in _plan(counted)
    with pytest.raises(ValueError, match="buckets"):
        writers.load_run(table.limit(1), f"{prefix}historical", "r", ("snapshot_date",))
