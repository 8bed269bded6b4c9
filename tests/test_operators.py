import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from snapstats.operators import dedup, joins, quantiles, ranks, series


@pytest.fixture(scope="module")
def numbers(spark):
    pick = random.Random(7)
    data = []
    for i in range(4000):
        hot = 5.0 if i % 3 == 0 else round(pick.gauss(0, 50), 2)
        rare = None if i % 5 == 0 else float("nan") if i % 7 == 0 else pick.random()
        data.append((i, hot, rare, pick.randrange(40)))
    return spark.createDataFrame(data, "id INT, hot DOUBLE, rare DOUBLE, small INT").repartition(6), data


def expected_quantiles(data, column, probabilities):
    values = [r[column] for r in data if r[column] is not None and not math.isnan(r[column])]
    return list(np.quantile(values, probabilities))


@pytest.mark.parametrize("limit, points, slack", [
    (1_000_000, 400, 5e-3), (20, 400, 5e-3), (1_000_000, 10, 1e-6), (30, 40, 1e-3)])
def test_quantiles_match_numpy(numbers, monkeypatch, limit, points, slack):
    df, data = numbers
    monkeypatch.setattr(quantiles, "GROUP_LIMIT", limit)
    monkeypatch.setattr(quantiles, "POINTS", points)
    monkeypatch.setattr(quantiles, "SLACK", slack)
    probabilities = (0.0, 0.25, 0.5, 0.99, 1.0)
    got = quantiles.quantiles(df, ["hot", "rare", "small"], probabilities)
    for i, c in enumerate(("hot", "rare", "small"), start=1):
        assert got[c] == pytest.approx(expected_quantiles(data, i, probabilities), abs=1e-12)


def test_sketch_counts_exactly_and_is_near(numbers):
    df, data = numbers
    counts, near = quantiles.sketch(df.select("hot", F.when(~F.isnan("rare"), F.col("rare")).alias("rare")),
                                    {"hot": [0.0, 0.9, 1.0], "rare": [0.5]}, groups=3)
    assert counts == {"hot": 4000, "rare": sum(r[2] is not None and not math.isnan(r[2]) for r in data)}
    assert near["hot"][0] == min(r[1] for r in data) and near["hot"][-1] == max(r[1] for r in data)
    assert near["rare"][0] == pytest.approx(expected_quantiles(data, 2, [0.5])[0], abs=0.02)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,), (None,)], "x DOUBLE")
    assert quantiles.quantiles(empty, ["x"], (0.5,)) == {"x": [None]}
    assert quantiles.quantiles(empty, ["x"], (0.5,), exact=False) == {"x": [None]}
    assert quantiles.quantiles(empty, [], (0.5,)) == {}


def test_ranks_match_window(numbers):
    df, _ = numbers
    df = df.withColumn("rare", F.when(~F.isnan("rare"), F.col("rare")))
    got = ranks.with_ranks(df, ["hot", "rare", "small"])
    want = df.select("*", *[F.rank().over(Window.orderBy(F.desc_nulls_last(c))).alias(f"w_{c}") for c in ("hot", "rare", "small")])
    both = got.join(want.select("id", "w_hot", "w_rare", "w_small"), "id")
    assert both.count() == 4000
    assert both.filter("hot_rank <> w_hot OR rare_rank <> w_rare OR small_rank <> w_small").count() == 0


def test_ranks_of_crowded_values_and_several_types(spark):
    """Nine tenths of the values lie in a millionth of the span; types, nulls and an empty table."""
    df = spark.range(20000).select(
        "id", F.when(F.col("id") % 10 == 0, F.col("id") * 1e6).otherwise(1 + F.col("id") / 1e7).alias("crowded"),
        F.when(F.col("id") % 7 != 0, (F.col("id") % 5).cast("string")).alias("word"), (F.lit(1 << 60) + F.col("id") % 3).alias("big"),
        F.lit(None).cast("date").alias("none"))
    columns = ("crowded", "word", "big", "none")
    got = ranks.with_ranks(df, columns)
    want = df.select("id", *[F.rank().over(Window.orderBy(F.desc_nulls_last(c))).cast("bigint").alias(f"{c}_rank") for c in columns])
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == 20000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # small ranges would be one
    try:
        cut, _ = ranks.counted_ranges(df, ["crowded"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held = [r["count"] for r in cut.groupBy("__range").count().collect()]
    assert len(held) > 1 and max(held) < 2 * 20000 / len(held)      # ranges are even, though the values are not
    assert ranks.with_ranks(df.limit(0), columns).collect() == []


def test_top_ranked_matches_window(numbers):
    df, _ = numbers
    df = df.withColumn("rare", F.when(~F.isnan("rare"), F.col("rare")))
    got = ranks.top_ranked(df, "small", {"small": "a", "rare": "b", "hot": "c"}, 120, ["id"])
    want = df.select("*", *[F.rank().over(Window.orderBy(F.desc_nulls_last(c))).alias(n) for c, n in (
        ("small", "a"), ("rare", "b"), ("hot", "c"))]).orderBy(F.desc("small"), "id").limit(120)
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]


def test_top_ranked_of_nothing(spark):
    empty = spark.createDataFrame([], "k STRING, v INT")
    assert ranks.top_ranked(empty, "v", {"v": "r"}, 5, ["k"]).collect() == []


def test_dedup_last_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").withColumn(
        "k", F.when(F.col("k") != 0, F.col("k")))
    out = dedup.dedup_last(df, ["k"], ["id"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")
    assert sorted((r["k"] or 0, r["id"]) for r in out.collect()) == [(0, 999), (1, 997), (2, 998)]


def test_dedup_is_idempotent(spark):
    df = spark.range(500).select((F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("v"))
    once = dedup.dedup_last(df, ["k"], ["v"])
    assert once.exceptAll(dedup.dedup_last(once, ["k"], ["v"])).isEmpty()


def test_dedup_rows_with_maps_inside(spark):
    df = spark.sql("""SELECT 1 AS a, map('x', 1, 'y', 2) AS m, array(map('p', map('q', 1))) AS d, named_struct('s', map('k', 1)) AS t
      UNION ALL SELECT 1, map('y', 2, 'x', 1), array(map('p', map('q', 1))), named_struct('s', map('k', 1))
      UNION ALL SELECT 1, map('y', 2, 'x', 3), array(map('p', map('q', 1))), named_struct('s', map('k', 1))
      UNION ALL SELECT 1, NULL, NULL, NULL""")
    out = dedup.dedup_rows(df)
    assert out.schema.simpleString() == df.schema.simpleString()
    assert out.count() == 3
    assert dedup.duplicate_stats(df).first().asDict() == {
        "row_count": 4, "duplicate_count": 1, "duplicate_percentage": 0.25}


def test_duplicate_stats_of_nothing(spark):
    assert tuple(dedup.duplicate_stats(spark.createDataFrame([], "a INT")).first()) == (0, 0, 0.0)


def test_upsert_new_wins_ties(spark):
    old = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old")], "k STRING, v INT, s STRING")
    new = spark.createDataFrame([("a", 1, "new"), ("b", 4, "new"), ("c", 0, "new")], "k STRING, v INT, s STRING")
    assert sorted(tuple(r) for r in dedup.upsert_latest(old, new, ["k"], ["v"]).collect()) == [
        ("a", 1, "new"), ("b", 5, "old"), ("c", 0, "new")]


def test_join_unique_spreads_hot_keys(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
        F.col("id").cast("string")).alias("k"), F.lit(1).alias("same"))
    right = spark.createDataFrame([("hot", 7), ("2", 8), ("none", 9)], "k STRING, v INT")
    assert "hot" in joins.hot_keys(left, "k")
    for how in ("left", "inner"):
        got = joins.join_unique(left, right, "k", how)
        want = left.join(right, "k", how)
        assert got.columns == want.columns
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_join_unique_balances_tasks(spark):
    """A third of the rows under one key, all alike, and a third without a key."""
    left = spark.range(0, 60_000, 1, 8).select(F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([("hot", 7)], "k STRING, v INT")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
                "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        largest = {
            name: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
            for name, df in (("salted", joins.join_unique(left, right, "k")), ("plain", left.join(right, "k", "left")))}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest["plain"] >= 20_000 and largest["salted"] < 10_000


# --- series ------------------------------------------------------------------


def frame(spark, values, country="A", metric="cases"):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame(
        [(day + dt.timedelta(days=i), metric, v, country) for i, v in enumerate(values)],
        "date DATE, metric STRING, value BIGINT, country STRING")


def column(df, name):
    return [r[name] for r in df.orderBy("country", "metric", "date").collect()]


def test_daily_change_fills_forward_and_guards_zero(spark):
    out = series.with_daily_change(frame(spark, [10, None, 20, 0, 5, 0, 0]))
    assert column(out, "daily_change") == [None, None, None, -20, 5, -5, 0]
    assert column(out, "daily_change_pct") == [None, 0.0, 1.0, -1.0, None, -1.0, None]
    ieee = series.with_daily_change(frame(spark, [0, 5, -5, 0, -2, 0, 0]), on_zero="inf")
    got = column(ieee, "daily_change_pct")
    assert got[1] == math.inf and got[4] == -math.inf and math.isnan(got[6]) and got[2] == -2.0


def test_rolling_ignores_nulls(spark):
    out = series.with_rolling(frame(spark, [1, None, 3, 4, 5, 6, 7, 8]), "value")
    assert column(out, "value_7day_avg") == [1, 1, 2, 8 / 3, 13 / 4, 19 / 5, 26 / 6, 33 / 6]


def test_series_do_not_mix(spark):
    both = frame(spark, [1, 2], "A").unionByName(frame(spark, [10, 20], "B"))
    assert column(series.with_daily_change(both), "daily_change") == [None, 1, None, 10]


def test_growth_and_doubling(spark):
    out = series.growth_rates(frame(spark, [100 * 2 ** i for i in range(15)]))
    assert column(out, "growth_rate_1day") == [None] + [1.0] * 14
    assert column(out, "growth_rate_14day") == [None] * 14 + [2 ** 14 - 1.0]
    doubling = column(out, "doubling_time_days")
    assert doubling[0] == math.inf and doubling[1:] == pytest.approx([1.0] * 14)
    flat = series.growth_rates(frame(spark, [5, 5, 4]))
    assert column(flat, "doubling_time_days") == [math.inf] * 3


def test_gaps_and_exclusion(spark):
    df = frame(spark, range(10)).filter("day(date) NOT IN (4, 5)")
    assert [(r["gap_days"], r["prev_date"].day) for r in series.date_gaps(df).collect()] == [(3, 3)]
    assert series.date_gaps(df.withColumn("country", F.lit("Global"))).isEmpty()


def test_last_days(spark):
    df = frame(spark, range(10))
    assert series.last_days(df, 3).count() == 3
    assert series.last_days(df, "all").count() == 10


def test_snapshot_flags(spark):
    df = spark.createDataFrame(
        [("A", dt.date(2024, 1, d), d) for d in (1, 2, 3)] + [("B", dt.date(2024, 1, 1), 9)], "country STRING, snapshot_date DATE, v INT")
    pick = lambda **k: sorted((r["country"], r["v"]) for r in series.snapshot_as_of(df, "2024-01-03", key="country", **k).collect())
    assert pick() == [("A", 3), ("B", 9)]
    assert pick(yesterday=True, two_days_ago=True) == [("A", 2), ("B", 9)]
    assert pick(two_days_ago=True) == [("A", 1), ("B", 9)]
    assert pick(yesterday=True, value="A") == [("A", 2)]
    assert [r["v"] for r in series.snapshot_as_of(df, "2024-01-03").collect()] == [3]
