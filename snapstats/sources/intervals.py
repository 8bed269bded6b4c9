"""Snapshots of any day without reading the past: each row is stored with the days over which it was the newest of its region.

A row holds from its day until ``valid_to``, the day of the region's next row, or on (null). The table is partitioned by the month in
which a row ends and sorted by the day it begins. A snapshot as of a day reads the partitions of that month and later; of these,
row groups that begin later are skipped by their statistics. Newest snapshots read the one partition of rows that hold on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snapstats.operators import dedup, joins, series
from snapstats.session import ensure_checkpoint_dir

VALID_TO = "valid_to"
ENDS = "ends_in"            # partition: year and month of valid_to as a number
OPEN = 999912
_START = "__start"


def month(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def append(spark: SparkSession, new: DataFrame, path: str, key: str, order=(), day: str = "snapshot_date") -> list[int]:
    """Put rows in the table, each in place of what it ends or splits; returns the partitions that were rewritten.

    A region has one row a day, the last by ``order`` (names), the newer append on ties; repeated rows count once. Days may come in any
    order: a late one splits the interval it falls into. A null key is a region; rows without a day are in no snapshot and are
    left out. New days in order rewrite the rows that hold on and the month they end in. Only rows of given regions that end
    after the region's first given day are computed anew, so a region may have any number of rows. One append at a time.
    """
    ensure_checkpoint_dir(spark)
    columns = new.columns
    new = dedup.dedup_last(new.filter(F.col(day).isNotNull()), [key, day], [*order, day]).checkpoint()
    known = _known(spark, path)
    if not known:
        rows = _bounded(new, key, day)
        _write(rows, path, day, "static")
        return sorted(r[0] for r in rows.select(ENDS).distinct().collect())      # one a month
    starts = new.groupBy(key).agg(F.min(day).alias(_START))
    first = new.agg(F.min(day).cast("date")).first()[0]      # a value, so that partitions are cut when the plan is made
    if first is None:
        return []
    stored = spark.read.parquet(path).filter(F.col(ENDS) >= first.year * 100 + first.month)
    chain = joins.matched(stored, starts, [key]).filter(F.col(VALID_TO).isNull() | (F.col(VALID_TO) > F.col(_START))).drop(_START)
    merged = dedup.upsert_latest(chain.select(*columns), new, [key, day], [*order, day])
    rows = _bounded(merged, key, day).checkpoint()
    touched = [r[0] for r in rows.select(ENDS).distinct().collect()]
    others = joins.matched(stored.filter(F.col(ENDS).isin(touched)), chain.select(key, day), [key, day], "left_anti")
    whole = others.unionByName(rows, allowMissingColumns=True).checkpoint()      # read before it is replaced
    _write(whole, path, day, "dynamic")
    return sorted(touched)


def snapshot_as_of(spark: SparkSession, path: str, as_of, yesterday: bool = False, two_days_ago: bool = False,
                   day: str = "snapshot_date") -> DataFrame:
    """The newest row of each region no newer than the wanted day, as ``series.snapshot_as_of`` finds it; no shuffle."""
    asked = series.asked_day(as_of, yesterday, two_days_ago)
    rows = spark.read.parquet(path).filter(F.col(ENDS) >= month(asked)).filter(F.col(day) <= asked)
    return rows.filter(F.col(VALID_TO).isNull() | (F.col(VALID_TO) > asked)).drop(VALID_TO, ENDS)


def _bounded(rows: DataFrame, key: str, day: str) -> DataFrame:
    ends = F.lead(day).over(Window.partitionBy(key).orderBy(day))
    return rows.withColumn(VALID_TO, ends.cast("date")).withColumn(ENDS, F.coalesce(month(F.col(VALID_TO)), F.lit(OPEN)))


def _write(rows: DataFrame, path: str, day: str, mode: str) -> None:
    rows.hint("rebalance", ENDS).sortWithinPartitions(ENDS, day).write.mode("overwrite").option(
        "partitionOverwriteMode", mode).partitionBy(ENDS).parquet(path)


def _known(spark: SparkSession, path: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)
