"""Row-framed time series functions and snapshot selection.

Series functions expect one row per series and day (``dedup.dedup_last`` makes it
so). A window group is then bounded by the number of days in the span, however
many raw observations a hot series had, since those are reduced before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapstats.functions import columns as C
from snapstats.operators.dedup import dedup_last
from snapstats.schemas import PARTITION_COLUMN

SERIES = ("country", "metric")


def _window(keys, order):
    return Window.partitionBy(*keys).orderBy(order)


def _filled(value: str, keys, order) -> Column:
    """Value carried forward over nulls, the base that percentage changes use."""
    return F.last(value, ignorenulls=True).over(
        _window(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def with_daily_change(df: DataFrame, keys=SERIES, order: str = "date", value: str = "value",
                      on_zero: str = "null", base: str | None = None) -> DataFrame:
    """Difference and relative change to the previous row of the series.

    ``base`` names a column that holds the value carried forward over nulls, where there is one.
    """
    window = _window(keys, order)
    carried = base or "__carried"
    rows = df if base else df.withColumn(carried, _filled(value, keys, order))
    return rows.withColumns({
        "daily_change": F.col(value) - F.lag(value, 1).over(window),
        "daily_change_pct": C.growth(F.col(carried), F.lag(carried, 1).over(window), on_zero),
    }).drop("__carried")


def with_rolling(df: DataFrame, column: str, rows: int = 7, name: str | None = None,
                 keys=SERIES, order: str = "date") -> DataFrame:
    """Mean of the last ``rows`` rows, nulls ignored, shorter at the start."""
    frame = _window(keys, order).rowsBetween(1 - rows, 0)
    return df.withColumn(name or f"{column}_{rows}day_avg", F.avg(column).over(frame))


def with_growth(df: DataFrame, lags=(1, 7, 14), keys=SERIES, order: str = "date",
                value: str = "value", on_zero: str = "null", base: str | None = None) -> DataFrame:
    """Relative change to the value 1, 7, 14 ... rows back; ``base`` as in ``with_daily_change``."""
    window = _window(keys, order)
    carried = base or "__carried"
    rows = df if base else df.withColumn(carried, _filled(value, keys, order))
    return rows.withColumns({
        f"growth_rate_{k}day": C.growth(F.col(carried), F.lag(carried, k).over(window), on_zero)
        for k in lags
    }).drop("__carried")


def with_doubling_time(df: DataFrame, rate: str = "growth_rate_1day") -> DataFrame:
    """Days to double at the current growth rate; infinite without growth."""
    g = F.col(rate)
    return df.withColumn(
        "doubling_time_days",
        F.when((g > 0) & ~F.isnan(g), F.lit(math.log(2)) / F.log1p(g)).otherwise(F.lit(float("inf"))),
    )


def growth_rates(df: DataFrame, on_zero: str = "null") -> DataFrame:
    return df.transform(with_growth, on_zero=on_zero).transform(with_doubling_time)


def date_gaps(df: DataFrame, keys=SERIES, order: str = "date", exclude: str | None = "Global",
              min_days: int = 2) -> DataFrame:
    """Previous date and distance in days, where the distance is at least ``min_days``."""
    rows = df if exclude is None else df.filter(F.col(keys[0]) != exclude)
    previous = F.lag(order, 1).over(_window(keys, order))
    return (
        rows.select(*keys, order).withColumn("prev_date", previous)
        .withColumn("gap_days", F.datediff(order, "prev_date"))
        .filter(F.col("gap_days") >= min_days)
    )


def last_days(df: DataFrame, n: int | str, column: str = "date") -> DataFrame:
    """Rows of the last ``n`` days that are present; ``'all'`` keeps everything."""
    if n == "all":
        return df
    newest = df.agg(F.max(F.col(column).cast("date"))).scalar()
    return df.filter(F.col(column).cast("date") > F.date_sub(newest, int(n)))


def asked_day(as_of, yesterday: bool = False, two_days_ago: bool = False) -> Column:
    """The wanted day; both flags together mean yesterday."""
    return F.date_sub(F.lit(str(as_of)).cast("date"), 1 if yesterday else 2 if two_days_ago else 0)


def snapshot_as_of(df: DataFrame, as_of, yesterday: bool = False, two_days_ago: bool = False,
                   day: str = "snapshot_date", key: str | None = None, value: str | None = None,
                   order=None, within: int | None = None) -> DataFrame:
    """Latest snapshot per region no newer than the wanted day.

    Flags as in ``asked_day``. ``day`` is the partition column: newer partitions
    are pruned, and with ``within`` also those more than that many days older, so that
    only a few partitions of a long table are read. ``value`` restricts to one region.
    """
    asked = asked_day(as_of, yesterday, two_days_ago)
    wanted = df.filter(F.col(day) <= asked)
    if within is not None:
        wanted = wanted.filter(F.col(day) >= F.date_sub(asked, within))
    if value is not None:
        wanted = wanted.filter(F.col(key) == value)
    if key is None:
        return wanted.filter(F.col(day) == wanted.agg(F.max(day)).scalar())
    return dedup_last(wanted, [key], order or [day])


def latest_only(df: DataFrame, column: str = "extraction_date", partition: str | None = PARTITION_COLUMN) -> DataFrame:
    """Rows that carry the greatest value of ``column``, e.g. the newest file or extraction.

    A table partitioned by the day of ``column`` is cut to its newest partition first, so
    older days are never read.
    """
    if partition in df.columns and partition != column:
        df = df.filter(F.col(partition) == df.agg(F.max(partition)).scalar())
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def apply_retention(df: DataFrame, column: str, days: int, as_of) -> DataFrame:
    """Rows not older than ``days`` days; on a partition column older days are pruned."""
    return df.filter(F.col(column) >= F.date_sub(F.lit(str(as_of)).cast("date"), days))
