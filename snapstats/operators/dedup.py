"""Duplicate removal and duplicate statistics.

A key may be as hot as it likes: keeping one row per key and counting rows per key
are both reduced inside each map task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_RANK = "__row"


def _descending(order) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c).desc_nulls_last() for c in order]


def dedup_last(df: DataFrame, keys, order) -> DataFrame:
    """Keep, per key, the row that is last by ``order`` (names, or ready-made sort columns).

    ``order`` should be total; null keys form a group of their own. The filter on
    ``row_number`` becomes a window group limit, so each map task sends at most one
    row per key.
    """
    window = Window.partitionBy(*keys).orderBy(*_descending(order))
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.MapType):
        return True
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return False


def _comparable(column: Column, kind: T.DataType) -> Column:
    """The same content in a form Spark can group by: maps become sorted entry lists."""
    if not _holds_map(kind):
        return column
    if isinstance(kind, T.MapType):
        entries = F.map_entries(column)
        if _holds_map(kind.valueType):
            entries = F.transform(
                entries, lambda e: F.struct(e["key"].alias("key"), _comparable(e["value"], kind.valueType).alias("value")))
        return F.array_sort(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda e: _comparable(e, kind.elementType))
    rebuilt = F.struct(*[_comparable(column[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.when(column.isNotNull(), rebuilt)


def _original(column: Column, kind: T.DataType) -> Column:
    if not _holds_map(kind):
        return column
    if isinstance(kind, T.MapType):
        entries = column
        if _holds_map(kind.valueType):
            entries = F.transform(
                column, lambda e: F.struct(e["key"].alias("key"), _original(e["value"], kind.valueType).alias("value")))
        return F.map_from_entries(entries)
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda e: _original(e, kind.elementType))
    rebuilt = F.struct(*[_original(column[f.name], f.dataType).alias(f.name) for f in kind.fields])
    return F.when(column.isNotNull(), rebuilt)


def comparable(df: DataFrame) -> DataFrame:
    """All columns in a form that supports grouping and equality."""
    return df.select(*[_comparable(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def dedup_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, for any column types (maps included)."""
    if not any(_holds_map(f.dataType) for f in df.schema.fields):
        return df.dropDuplicates()
    unique = comparable(df).dropDuplicates()
    return unique.select(*[_original(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def duplicate_stats(df: DataFrame, keys=None) -> DataFrame:
    """One row: rows, surplus rows beyond the first of each key, their share.

    Without keys whole rows are compared, by two hashes of them (96 bits): only these are shuffled.
    """
    rows = comparable(df.select(*keys) if keys else df)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    if not keys:
        text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        rows = rows.select(F.xxhash64(*columns).alias("one"), F.crc32(text.cast("binary")).alias("two"))
        columns = ["one", "two"]
    per_key = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    surplus = F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(total.alias("row_count"), surplus.alias("duplicate_count")).withColumn(
        "duplicate_percentage",
        F.coalesce(F.try_divide(F.col("duplicate_count"), F.col("row_count")), F.lit(0.0)),
    )


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def dedup(df: DataFrame, dataset: str, order) -> DataFrame:
    """The rule of a data set: countries by name, series by point, others by whole row."""
    if dataset == "countries":
        return dedup_last(df, ["country"], order)
    if dataset == "historical":
        return dedup_last(df, ["date", "country", "metric"], order)
    return dedup_rows(df)


def upsert_latest(existing: DataFrame, new: DataFrame, keys, order) -> DataFrame:
    """Union of both sides, last row per key by ``order``; ``new`` wins ties."""
    side = "__side"
    both = existing.withColumn(side, F.lit(0)).unionByName(
        new.withColumn(side, F.lit(1)), allowMissingColumns=True)
    return dedup_last(both, keys, [*order, side]).drop(side)
