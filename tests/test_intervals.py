import datetime as dt
import random

from pyspark.sql import functions as F

from snapstats.operators import series
from snapstats.sources import intervals

DAY = dt.date(2024, 1, 1)


def _frame(spark, rows):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d), k, v) for d, k, v in rows], "snapshot_date DATE, region STRING, v INT")


def _rows(df):
    return sorted(((str(r["snapshot_date"]), str(r["region"]), r["v"]) for r in df.collect()))


def test_any_day_after_appends_in_any_order(spark, tmp_path):
    pick = random.Random(5)
    given = [(pick.randrange(400), pick.choice(["a", "b", "c", None, ""]), n) for n in range(120)]
    path, seen = str(tmp_path / "t"), []
    for part in (given[:60], given[60:61], given[61:], given[:3], []):
        intervals.append(spark, _frame(spark, part), path, "region", ["v"])
        seen += part
        whole = _frame(spark, seen).dropDuplicates()
        for day in (-1, 0, 31, 150, 399, 500):
            want = series.snapshot_as_of(whole, DAY + dt.timedelta(days=day), key="region", order=["snapshot_date", "v"])
            assert _rows(intervals.snapshot_as_of(spark, path, DAY + dt.timedelta(days=day))) == _rows(want)
    asked = DAY + dt.timedelta(days=200)
    want = series.snapshot_as_of(whole, asked, yesterday=True, two_days_ago=True, key="region", order=["snapshot_date", "v"])
    assert _rows(intervals.snapshot_as_of(spark, path, asked, True, True)) == _rows(want)


def test_days_in_order_rewrite_two_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    intervals.append(spark, _frame(spark, [(d, k, d) for d in range(0, 300, 3) for k in "abc"]), path, "region", ["v"])
    assert intervals.append(spark, _frame(spark, [(310, "a", 1)]), path, "region", ["v"]) == [202411, intervals.OPEN]
    assert intervals.append(spark, _frame(spark, [(100, "b", 1)]), path, "region", ["v"])[0] == 202404


def test_past_partitions_are_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    intervals.append(spark, _frame(spark, [(d, k, d) for d in range(0, 300, 3) for k in "abc"]), path, "region", ["v"])
    months = {r[0] for r in spark.read.parquet(path).select("ends_in").distinct().collect()}
    found = intervals.snapshot_as_of(spark, path, "2024-09-15")
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString() and "PushedFilters: [IsNotNull(snapshot_date)" in plan.toString()
    found._jdf.collectToPython()
    read = plan.collectLeaves().apply(0).metrics().apply("numPartitions").value()
    assert 0 < read == len({m for m in months if m >= 202409}) < len(months)


def test_rows_without_a_day_and_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = _frame(spark, [(1, "a", 1), (1, "a", 1), (1, "a", 2)])
    undated = rows.withColumn("snapshot_date", F.lit(None).cast("date"))
    intervals.append(spark, rows.unionByName(undated), path, "region", ["v"])
    assert intervals.append(spark, undated, path, "region", ["v"]) == []
    assert _rows(intervals.snapshot_as_of(spark, path, "2024-12-31")) == [("2024-01-02", "a", 2)]
