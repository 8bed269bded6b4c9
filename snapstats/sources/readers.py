"""Readers: landing payloads, stored data sets and series built from nested maps.

Schemas are explicit everywhere, so no pass is spent on inference.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapstats import schemas as S
from snapstats.functions import columns as C
from snapstats.operators import clean
from snapstats.operators.series import last_days

FORMATS = ("parquet", "csv", "json")
# Columns that only live between a landing file and its rows: text of a record that could not be
# read whole, and the place it was read from.
CORRUPT, PATH, BLOCK = "__corrupt", "__path", "__block"
REJECTS = "file STRING, dataset STRING, reason STRING, record STRING"


def read_snapshot(spark: SparkSession, path, dataset: str, as_of=None, source: str = "api",
                  lines: bool = False) -> DataFrame:
    """Landing JSON of one data set: typed, with lineage, ``updated`` as timestamp.

    A payload document (object or array) is read whole by one task, so large landings
    should be many files, or JSON lines (``lines=True``), which Spark splits.
    """
    return from_payload(landing(spark.read, path, dataset, lines), dataset, as_of, source)


def landing(reader, path, dataset: str, lines: bool = False) -> DataFrame:
    """Payload rows of landing files, by a batch or a stream reader; nothing is dropped.

    Values of maps are read as text, so that one bad value does not cost its document.
    """
    schema = re.sub(r"(?i)map<string, *bigint>", "map<string,string>", S.RAW_SCHEMAS[dataset])
    raw = (
        reader.schema(f"{schema}, {CORRUPT} STRING").option("multiLine", not lines).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).json(path)
    )
    return raw.select("*", F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias(BLOCK))


def _payload(raw: DataFrame) -> list[str]:
    return [c for c in raw.columns if c not in (CORRUPT, PATH, BLOCK)]


def _any_read(raw: DataFrame) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in _payload(raw)])


def accepted(raw: DataFrame) -> DataFrame:
    """Rows of which anything could be read, with their place in the landing: file, block and row."""
    if CORRUPT not in raw.columns:
        return raw
    good = raw.filter(F.col(CORRUPT).isNull() | _any_read(raw))
    place = F.struct(F.col(PATH).alias("file"), F.col(BLOCK).alias("block"), F.monotonically_increasing_id().alias("row"))
    return good.withColumn(S.SEQUENCE_COLUMN, place).drop(CORRUPT, PATH, BLOCK)


def rejected(raw: DataFrame, dataset: str) -> DataFrame:
    """What ``accepted`` left out, and what it kept in part: file, data set, reason, text."""
    name = F.substring_index(PATH, "/", -1).alias("file")
    whole = raw.filter(F.col(CORRUPT).isNotNull()).select(
        name, F.lit(dataset).alias("dataset"),
        F.when(_any_read(raw), "unreadable field").otherwise("malformed document").alias("reason"),
        F.col(CORRUPT).alias("record"))
    maps = _maps(raw, dataset)
    if not maps:
        return whole
    keep = ("country",) if "country" in raw.columns else ()
    values = explode_maps(raw, maps, keep=(PATH, *keep)).filter(F.col("value").isNotNull() & F.col("value").try_cast("bigint").isNull())
    return whole.unionByName(values.select(
        name, F.lit(dataset).alias("dataset"), F.lit("unreadable value").alias("reason"),
        F.concat_ws(" ", *keep, "metric", "date", "value").alias("record")))


def _maps(raw: DataFrame, dataset: str) -> dict[str, Column]:
    """Maps of dates to numbers in a payload, by metric."""
    if dataset == "historical":
        return {m: F.col(m) for m in S.METRICS if m in raw.columns}
    if dataset == "vaccines":
        return {"doses": F.col("timeline")}
    if dataset in S.SERIES_DATASETS:
        fields = raw.schema["timeline"].dataType.fieldNames()
        return {m: F.col("timeline")[m] for m in S.METRICS if m in fields}
    return {}


def read_rejects(spark: SparkSession, path, dataset: str, lines: bool = False) -> DataFrame:
    """Records and values of landing files that could not be read, with their file and the reason."""
    return rejected(landing(spark.read, path, dataset, lines), dataset)


def from_payload(raw: DataFrame, dataset: str, as_of=None, source: str = "api") -> DataFrame:
    """Lineage, time conversion and flattening of payload rows (batch or stream).

    Countries and histories keep their place in the landing (path of the file, then position), since
    the last of several rows of one key is the one that counts.
    """
    raw = accepted(raw)
    if dataset in S.SERIES_DATASETS:
        return clean.with_lineage(_series(raw, dataset), as_of, source, dataset)
    df = clean.epoch_ms_to_ts(clean.with_lineage(raw, as_of, source, dataset))
    if dataset == "vaccines" and df.schema["timeline"].dataType.valueType.typeName() == "string":
        numbers = F.transform_values("timeline", lambda _, v: v.try_cast("bigint"))
        unread = lambda k, v: v.isNull() | v.try_cast("bigint").isNotNull()
        df = df.withColumn("timeline", F.map_filter("timeline", unread)).withColumn("timeline", numbers)
    if dataset != "countries":
        return df.drop(S.SEQUENCE_COLUMN)
    return clean.flatten_struct(df, "countryInfo", "country_")


def _series(raw: DataFrame, dataset: str) -> DataFrame:
    return history_long(raw) if dataset == "historical" else country_history_long(raw)


def explode_maps(df: DataFrame, maps: dict[str, Column], keep=()) -> DataFrame:
    """Map columns to long rows (*keep, date text, metric, value); absent maps give no rows."""
    tagged = F.array(*[_tagged(name, column) for name, column in maps.items()])
    return df.select(*keep, F.explode(F.flatten(tagged)).alias("p")).select(*keep, "p.*")


def _tagged(metric: str, column: Column) -> Column:
    entries = F.coalesce(F.map_entries(column), F.array())
    return F.transform(entries, lambda e: F.struct(
        e["key"].alias("date"), F.lit(metric).alias("metric"), e["value"].alias("value")))


def _parse_date(df: DataFrame, fmt: str = S.SERIES_DATE_FORMAT) -> DataFrame:
    text = F.col("date")
    parsed = F.coalesce(F.try_to_timestamp(text, F.lit(fmt)), F.try_to_timestamp(text))
    number = F.col("value").try_cast("bigint")
    return df.filter(F.col("value").isNull() | number.isNotNull()).withColumn("value", number).withColumn(
        "date", parsed.cast("date"))


def _place(df: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in (S.SEQUENCE_COLUMN,) if c in df.columns)


def history_long(df: DataFrame, metrics=S.METRICS) -> DataFrame:
    """Global history ``{metric: {date: value}}`` to rows (date, metric, value, country='Global')."""
    rows = explode_maps(df, {m: F.col(m) for m in metrics if m in df.columns}, keep=_place(df))
    return _parse_date(rows).withColumn("country", F.lit("Global"))


def country_history_long(df: DataFrame, countries=None, days: int | str | None = None,
                         metrics=S.METRICS) -> DataFrame:
    """Country histories under ``timeline`` to rows; optionally some countries, last ``days`` days.

    Documents without a timeline yield no rows; values that are no numbers are ``rejected``.
    """
    wanted = df if countries is None else df.filter(F.col("country").isin(list(countries)))
    fields = df.schema["timeline"].dataType.fieldNames()
    rows = explode_maps(wanted, {m: F.col("timeline")[m] for m in metrics if m in fields}, keep=("country", *_place(df)))
    rows = _parse_date(rows).select("date", "metric", "value", "country", *_place(df))
    return rows if days is None else last_days(rows, days)


def vaccines_long(df: DataFrame) -> DataFrame:
    """Vaccination timelines ``{date: doses}`` to rows (country, date, doses)."""
    rows = explode_maps(df, {"doses": F.col("timeline")}, keep=("country",))
    return _parse_date(rows).select("country", "date", F.col("value").alias("doses"))


def read_series(spark: SparkSession, path, dataset: str, as_of=None, source: str = "api",
                countries=None, days: int | str | None = None, lines: bool = False) -> DataFrame:
    """Landing JSON of a history; ``read_rejects`` has what could not be read of it."""
    raw = accepted(landing(spark.read, path, dataset, lines))
    if dataset == "historical":
        rows = history_long(raw)
        rows = rows if days is None else last_days(rows, days)
    else:
        rows = country_history_long(raw, countries, days)
    return clean.with_lineage(rows, as_of, source, dataset)


def read_all(spark: SparkSession, landing: str, as_of=None, source: str = "api",
             include_history: bool = True, days: int | str | None = 30,
             datasets=S.SNAPSHOT_DATASETS + ("vaccines",), lines: bool = False) -> dict[str, DataFrame]:
    """All landing data sets (one folder each) as lazy DataFrames."""
    bundle = {d: read_snapshot(spark, f"{landing}/{d}", d, as_of, source, lines) for d in datasets}
    if include_history:
        bundle["historical"] = read_series(
            spark, f"{landing}/historical", "historical", as_of, source, days=days, lines=lines)
    return bundle


def format_of(path: str) -> str:
    """Format named by the path's suffix; Parquet without one."""
    suffix = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    return suffix if suffix in FORMATS else "parquet"


def read_dataset(spark: SparkSession, path: str, fmt: str | None = None,
                 schema: T.StructType | str | None = None, multiline: bool = False) -> DataFrame:
    """Read back Parquet, CSV (header, quotes doubled) or JSON lines on any Hadoop file system.

    ``multiline`` reads CSV cells that hold line breaks; each file is then one task's work,
    which suits files this engine wrote but not one huge file.
    """
    fmt = (fmt or format_of(path)).lower()
    if fmt not in FORMATS:
        raise ValueError(f"unsupported file format: {fmt}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).option("escape", '"').option("multiLine", multiline).csv(path)
    return reader.parquet(path) if fmt == "parquet" else reader.json(path)


def latest_file(df: DataFrame) -> DataFrame:
    """Rows of the newest file of a data set: greatest file name, names end in a timestamp."""
    named = df.select("*", F.col("_metadata.file_name").alias("__file"))
    newest = df.select(F.col("_metadata.file_name").alias("f")).agg(F.max("f")).scalar()
    return named.filter(F.col("__file") == newest).drop("__file")


def parse_literal(column: Column | str, ddl: str) -> Column:
    """Struct or array text as written by Python (single quotes, ``None``) to a typed column."""
    text = C.as_col(column)
    for word, json in (("None", "null"), ("True", "true"), ("False", "false")):
        text = F.regexp_replace(text, rf"([:\[,] ?){word}(?=[,\]}}])", f"$1{json}")
    return F.from_json(text, ddl, {"allowSingleQuotes": "true"})
