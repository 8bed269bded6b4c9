import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapstats.operators import series
from snapstats.streaming import tail

SCHEMA = "date DATE, country STRING, metric STRING, value BIGINT, version INT"
COLUMNS = ("country", "metric", "date", "value", "daily_change", "daily_change_pct", "value_7day_avg", "daily_change_7day_avg",
           "growth_rate_1day", "growth_rate_7day", "growth_rate_14day")
DAY = dt.date(2024, 1, 1)


def _frame(spark, rows):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d), c, m, v, n) for d, c, m, v, n in rows], SCHEMA)


def _rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def _whole(spark, appends):
    """All windows over the last version of every point, at once."""
    last = {}
    for rows in appends:
        for d, c, m, v, n in rows:
            if (c, m, d) not in last or n >= last[c, m, d][-1]:
                last[c, m, d] = (d, c, m, v, n)
    df = series.with_daily_change(_frame(spark, last.values()))
    return _rows(series.with_growth(series.with_rolling(series.with_rolling(df, "value"), "daily_change")))


def _stored(spark, appends, out):
    for rows in appends:
        tail.advance(spark, _frame(spark, rows), out, ["version"], lags=(1, 7, 14))
    return _rows(tail.stored(spark, out))


def _series(days, country, version, seed):
    pick = random.Random(seed)
    return [(d, country, "cases", pick.choice([None, 0, 3, 8, 40]), version) for d in days]


def test_days_in_order_late_and_restated(spark, tmp_path):
    appends = [
        _series(range(0, 40), "A", 0, 1) + _series(range(0, 90, 9), "sparse", 0, 2) + _series(range(0, 40), None, 0, 3),
        _series(range(40, 43), "A", 1, 4) + _series([95], "sparse", 1, 5) + _series(range(0, 2), "new", 1, 6) + _series([41], None, 1, 7),
        _series([10, 17, 43], "A", 2, 8) + _series([91], "sparse", 2, 9) + _series([3], None, 2, 10),
        _series([200], "A", 3, 11) + _series([42], "A", 0, 12),      # a restatement older than what is stored
        _series([195, 199], "A", 4, 13),
    ]
    assert _stored(spark, appends, str(tmp_path)) == _whole(spark, appends)


def test_a_repeated_append_changes_nothing(spark, tmp_path):
    appends = [_series(range(0, 30), "A", 0, 1), _series(range(30, 35), "A", 1, 2)]
    assert _stored(spark, [*appends, appends[1], appends[1]], str(tmp_path)) == _whole(spark, appends)


def test_a_value_is_carried_over_a_whole_tail_of_nulls(spark, tmp_path):
    nulls = [(d, "A", "cases", None, 0) for d in range(1, 30)]
    appends = [[(0, "A", "cases", 5, 0), *nulls], [(30, "A", "cases", 10, 1)], [(20, "A", "cases", None, 2)]]
    got = _stored(spark, appends, str(tmp_path))
    assert got == _whole(spark, appends)
    assert [r[5] for r in got if r[2] == DAY + dt.timedelta(days=30)] == [1.0]


def test_repeated_rows_no_rows_and_no_day(spark, tmp_path):
    twice = _series(range(0, 5), "A", 0, 1)
    out = str(tmp_path)
    tail.advance(spark, _frame(spark, twice + twice), out, ["version"], lags=(1, 7, 14))
    tail.advance(spark, _frame(spark, []), out, ["version"], lags=(1, 7, 14))
    undated = _frame(spark, [(0, "A", "cases", 1, 1)]).withColumn("date", F.lit(None).cast("date"))
    tail.advance(spark, undated, out, ["version"], lags=(1, 7, 14))
    assert _rows(tail.stored(spark, out)) == _whole(spark, [twice])
    with pytest.raises(ValueError):
        tail.advance(spark, undated, out, ["version"], lags=(15,))


def test_what_is_read(spark, tmp_path, monkeypatch):
    """Days in order read no stored points but those of their own days; a late day only the partitions from 56 days before it."""
    out = str(tmp_path)
    tail.advance(spark, _frame(spark, _series(range(0, 200), "A", 0, 1)), out, ["version"])
    asked = []
    looked = tail._since

    def spy(*given):
        rows = looked(*given)
        asked.append({r[0] for r in rows.select("snapshot_date").distinct().collect()})
        files = rows.select("snapshot_date").inputFiles()
        assert files
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(snapshot_date" in plan
        return rows

    monkeypatch.setattr(tail, "_since", spy)
    tail.advance(spark, _frame(spark, _series([200], "A", 1, 2)), out, ["version"])
    assert not asked
    tail.advance(spark, _frame(spark, _series([190], "A", 2, 3)), out, ["version"])
    assert min(asked[0]) == DAY + dt.timedelta(days=190 - tail.FIRST_LOOK)
