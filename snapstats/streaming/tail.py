"""Windows over daily series, kept up from the last rows of each series.

``out/data`` holds every point with its windows, partitioned by day; ``out/tail`` holds the last rows of each series, as many as
the longest window looks back, partitioned by a hash of the series. New days are joined to their tails alone. A point that is late
or restated reaches back into ``data``, to the rows before the first point it touches, and what follows it is computed anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snapstats import schemas as S
from snapstats.operators import dedup, joins, series
from snapstats.session import ensure_checkpoint_dir

ROWS = 14               # rows of a tail: the longest lag; a mean of 7 changes needs 7
BUCKETS = 64            # partitions of the tails; those of touched series are replaced
FIRST_LOOK = 4 * ROWS   # days a late point looks back at first; doubled until its series has enough rows
CARRIED = "carried_value"
_FIRST, _BUCKET, _CONTEXT, _START, _LAST = "first_date", "tail_bucket", "__context", "__start", "__last"


def stored(spark: SparkSession, out: str) -> DataFrame:
    """Every point with its windows."""
    return spark.read.parquet(f"{out}/data").drop(CARRIED)


def advance(spark: SparkSession, new: DataFrame, out: str, version, keys=series.SERIES, order: str = "date",
            value: str = "value", lags=(), on_zero: str = "null") -> None:
    """Put new points in ``out`` with daily change, 7-row means and growth over ``lags`` (at most 14 rows).

    A point (``keys`` and ``order``) is stored once, the greatest ``version`` (column names), the newer batch on ties. Null keys are
    values; points without a day are left out; repeated rows count once. ``data`` is written before ``tail``: an append that was cut
    off may be repeated, as its points then count as restated. One append at a time.
    """
    if max(lags, default=0) > ROWS:
        raise ValueError(f"a tail has {ROWS} rows")
    ensure_checkpoint_dir(spark)
    points = [*keys, order]
    new = dedup.dedup_last(new.filter(F.col(order).isNotNull()), points, list(version)).checkpoint()
    known = _complete(spark, f"{out}/tail")
    empty = new.withColumns({_CONTEXT: F.lit(False), CARRIED: F.lit(None).cast(new.schema[value].dataType),
                             _FIRST: F.lit(None).cast(new.schema[order].dataType)})
    tail = None
    if known:
        starts = new.groupBy(*keys).agg(F.min(order).alias(_START))
        buckets = [r[0] for r in starts.select(_bucket(keys).alias(_BUCKET)).distinct().collect()]      # 64 at most
        tail = spark.read.parquet(f"{out}/tail").filter(F.col(_BUCKET).isin(buckets))
        work = _with_past(spark, empty, tail, starts, out, version, keys, order)
    else:
        work = empty
    computed = _windows(work, keys, order, value, lags, on_zero).checkpoint()
    _write_points(spark, computed.filter(~F.col(_CONTEXT)).drop(_CONTEXT, _FIRST), f"{out}/data", points, order, known)
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    last = computed.select(*points, value, CARRIED, _FIRST, newest.alias("__n")).filter(F.col("__n") <= ROWS).drop("__n")
    last = last.withColumn(_BUCKET, _bucket(keys))
    if known:
        last = joins.matched(tail, starts, keys, "left_anti").unionByName(last).checkpoint()      # read before it is replaced
    _replace(last, f"{out}/tail", _BUCKET, known)


def _with_past(spark, new: DataFrame, tail: DataFrame, starts: DataFrame, out: str, version, keys, order) -> DataFrame:
    """New points, the rows before them that their windows see, and the stored points that follow a late one."""
    ends = joins.matched(tail, starts, keys).withColumn(_LAST, F.max(order).over(Window.partitionBy(*keys)))
    context = ends.filter(F.col(_LAST) < F.col(_START)).drop(_START, _LAST, _BUCKET).withColumn(_CONTEXT, F.lit(True))
    late = ends.filter(F.col(_LAST) >= F.col(_START)).groupBy(*keys).agg(F.min(_START).alias(_START), F.min(_FIRST).alias(_FIRST))
    reach = late.agg(F.min(_START), F.min(_FIRST)).first()
    if reach[0] is None:
        return new.unionByName(context, allowMissingColumns=True)
    late = late.checkpoint()
    rows = _since(spark, f"{out}/data", late, reach, keys, order)
    before = rows.filter(F.col(order) < F.col(_START))
    near = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    before = before.withColumn("__n", near).filter(F.col("__n") <= ROWS).withColumn(_CONTEXT, F.lit(True))
    after = rows.filter(F.col(order) >= F.col(_START)).withColumn(_CONTEXT, F.lit(False))
    columns = lambda df: df.select(*[c for c in new.columns if c in df.columns])
    return dedup.upsert_latest(columns(after), new, [*keys, order], list(version)).unionByName(
        context, allowMissingColumns=True).unionByName(columns(before), allowMissingColumns=True)


def _since(spark, data: str, late: DataFrame, reach, keys, order) -> DataFrame:
    """Stored points of late series, from far enough back that 14 rows, or all there are, come before the late point.

    Only the partitions of these days are read. A series that began later needs no more.
    """
    first, begin = (d.date() if isinstance(d, dt.datetime) else d for d in reach)
    look = FIRST_LOOK
    while True:
        since = max(begin, first - dt.timedelta(days=look))
        rows = joins.matched(spark.read.parquet(data).filter(F.col(S.PARTITION_COLUMN) >= F.lit(since)), late, keys)
        if since == begin:
            return rows
        longer = late.filter(F.col(_FIRST) < F.lit(since)).select(*keys)
        found = rows.filter(F.col(order) < F.col(_START)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(
            F.col("__n") >= ROWS)
        if joins.matched(longer, found, keys, "left_anti").isEmpty():
            return rows
        look *= 2


def _windows(work: DataFrame, keys, order, value, lags, on_zero) -> DataFrame:
    past = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.coalesce(F.col(value), F.when(F.col(_CONTEXT), F.col(CARRIED)))
    rows = work.withColumn(CARRIED, F.last(known, ignorenulls=True).over(past)).withColumn(
        _FIRST, F.min(F.coalesce(_FIRST, order)).over(Window.partitionBy(*keys)))
    rows = series.with_daily_change(rows, keys, order, value, on_zero, base=CARRIED)
    for column in (value, "daily_change"):
        rows = series.with_rolling(rows, column, keys=keys, order=order)
    return series.with_growth(rows, lags, keys, order, value, on_zero, base=CARRIED) if lags else rows


def _write_points(spark, fresh: DataFrame, data: str, points, order, known: bool) -> None:
    """Replace the days of the points; other series' points of these days are kept."""
    day = S.PARTITION_COLUMN
    fresh = fresh.withColumn(day, F.col(order).cast("date"))
    if known:
        days = [r[0] for r in fresh.select(day).distinct().collect()]      # one value a day
        there = spark.read.parquet(data).filter(F.col(day).isin(days))
        others = joins.matched(there, fresh.select(*points), points, "left_anti")
        if not others.isEmpty():
            fresh = fresh.unionByName(others, allowMissingColumns=True).checkpoint()      # read before it is replaced
    _replace(fresh.hint("rebalance", day), data, day, known)


def _replace(rows: DataFrame, folder: str, by: str, known: bool) -> None:
    """The first write replaces the folder and leaves its mark of success there, later ones replace the partitions they have."""
    mode = "dynamic" if known else "static"
    rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(by).parquet(folder)


def _bucket(keys) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _complete(spark: SparkSession, folder: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)
