"""Ranks over a whole table without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapstats.session import ensure_checkpoint_dir

# Columns of the counted values: the ranked column a value is of, its range, and the rows that hold it.
_COLUMN, _RANGE, _COUNT = "__column", "__range", "__n"


def counted_ranges(df: DataFrame, columns) -> tuple[DataFrame, dict[str, str]]:
    """Distinct values of all columns with their counts and ranges, and the name of each column's values.

    All columns are counted in one pass, so a hot value is one row, and cut into as many ranges as there are shuffle partitions,
    by a sample of the distinct values; a range holds about as many values as another, wherever they lie. The result is
    checkpointed in the shared folder: ranges come from a sample, and a lost executor must not see them cut anew.
    """
    ensure_checkpoint_dir(df.sparkSession)
    kinds = list(dict.fromkeys(df.schema[c].dataType for c in columns))
    place = {c: f"__v{kinds.index(df.schema[c].dataType)}" for c in columns}      # values of one type share a column
    values = [f"__v{i}" for i in range(len(kinds))]
    held = lambda c, v, kind: (F.col(f"`{c}`") if place[c] == v else F.lit(None).cast(kind)).alias(v)
    tagged = F.array(*[F.struct(F.lit(c).alias(_COLUMN), *[held(c, v, k) for v, k in zip(values, kinds)]) for c in columns])
    counted = (
        df.select(F.explode(tagged).alias("t")).select("t.*").dropna("all", subset=values)
        .groupBy(_COLUMN, *values).agg(F.count(F.lit(1)).alias(_COUNT))
    )
    cut = counted.repartitionByRange(_COLUMN, *map(F.desc, values)).withColumn(_RANGE, F.spark_partition_id())
    return cut.checkpoint(), place


def value_ranks(cut: DataFrame, values: list[str]) -> DataFrame:
    """Rank (descending, ties share) of every counted value, as a prefix sum.

    Within a range a window sums the counts; one total of each range is added up over the ranges above.
    """
    before = Window.unboundedPreceding, -1
    inside = Window.partitionBy(_COLUMN, _RANGE).orderBy(*map(F.desc, values)).rowsBetween(*before)
    totals = cut.groupBy(_COLUMN, _RANGE).agg(F.sum(_COUNT).alias("total"))
    higher = Window.partitionBy(_COLUMN).orderBy(_RANGE).rowsBetween(*before)      # one row per range
    above = totals.select(_COLUMN, _RANGE, F.coalesce(F.sum("total").over(higher), F.lit(0)).alias("above"))
    return (
        cut.withColumn("greater", F.coalesce(F.sum(_COUNT).over(inside), F.lit(0))).join(above, [_COLUMN, _RANGE])
        .withColumn("rank", F.col("above") + F.col("greater") + 1)
    )


def with_ranks(df: DataFrame, columns, names: dict[str, str] | None = None) -> DataFrame:
    """Add ``<column>_rank`` over the whole set: descending, ties share, nulls last.

    The join back is on the ranked value; a value that many rows share is one row on
    the other side, so AQE can split the hot side.
    """
    cut, place = counted_ranges(df, columns)
    ranked = value_ranks(cut, sorted(set(place.values())))
    out = df
    for c in columns:
        name = (names or {}).get(c, f"{c}_rank")
        mine = F.col(_COLUMN) == c
        ranks = ranked.filter(mine).select(F.col(place[c]).alias("__value"), F.col("rank").alias(name))
        last = cut.filter(mine).agg(F.coalesce(F.sum(_COUNT), F.lit(0)) + 1).scalar()
        out = out.join(ranks, F.col(f"`{c}`") == F.col("__value"), "left").drop("__value")
        out = out.withColumn(name, F.coalesce(F.col(name), last))
    return out


def top_ranked(df: DataFrame, by: str, ranked: dict[str, str], n: int, tiebreak=()) -> DataFrame:
    """First ``n`` rows by ``by`` (descending), each with its ranks over the whole set.

    ``ranked`` maps column to rank name. A rank is one more than the number of greater
    values, so it is enough to count all rows by how many of the result's (at most
    ``n``) values they exceed: nothing but ``n`` counters per metric is shuffled.
    """
    order = [F.desc_nulls_last(by), *[F.asc(c) for c in tiebreak]]
    columns = list(ranked)
    top = df.orderBy(*order).limit(n)
    best = top.agg(F.struct(
        F.collect_list(F.struct(*df.columns)).alias("rows"),
        *[F.array_sort(F.collect_set(c)).alias(f"cut_{c}") for c in columns],
    ).alias("best")).scalar()

    measured = df.select(*columns).withColumn("best", best).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.when(F.col(c).isNotNull(), _passed(c)).alias("passed"))
        for c in columns
    ])).alias("p")).select("p.*").filter(F.col("passed").isNotNull())
    counters = measured.groupBy("metric", "passed").agg(F.count(F.lit(1)).alias("rows"))
    places = counters.groupBy("metric").agg(F.collect_list(F.struct("passed", "rows")).alias("places")).agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "places"))).alias("places"))

    out = places.withColumn("best", best).select("best", "places", F.explode("best.rows").alias("row"))
    return out.select("row.*", *[_rank(c).alias(ranked[c]) for c in columns]).orderBy(*order)


def _passed(column: str) -> Column:
    """How many cuts the row's value exceeds; most rows are done after the lowest one."""
    cuts = F.col(f"best.cut_{column}")
    return F.when(F.col(column) <= F.get(cuts, F.lit(0)), F.lit(0)).otherwise(
        F.size(F.filter(cuts, lambda cut: cut < F.col(column))))


def _rank(column: str) -> Column:
    # Greater than the k-th cut means having passed at least k cuts; a null value
    # (k = 0) ranks after all others.
    k = F.coalesce(F.array_position(F.col(f"best.cut_{column}"), F.col(f"row.{column}")).cast("int"), F.lit(0))
    ahead = F.filter(F.col("places")[column], lambda p: p["passed"] >= k)
    return F.aggregate(ahead, F.lit(0).cast("bigint"), lambda total, p: total + p["rows"]) + 1
