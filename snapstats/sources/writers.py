"""Writers, warehouse tables and their bookkeeping.

Row counts in manifests and reconciliations come from what was written, not from
accumulators, so a retried task cannot inflate them.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapstats import schemas as S
from snapstats.operators import dedup
from snapstats.session import ensure_checkpoint_dir
from snapstats.sources import readers

JDBC_BATCH = 10_000
PARALLEL_WRITES = 4
# Times in text files keep their microseconds.
TEXT_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
MANIFEST_SCHEMA = (
    "data_type STRING, uri STRING, file_format STRING, record_count BIGINT, column_count INT, "
    "status STRING, error STRING"
)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def write_dataset(df: DataFrame, uri: str, fmt: str = "parquet", mode: str = "append",
                  partition_by=()) -> str:
    """Write Parquet, CSV or JSON lines (ISO dates). Nested columns become JSON text in CSV."""
    fmt = fmt.lower()
    if fmt not in readers.FORMATS:
        raise ValueError(f"unsupported file format: {fmt}")
    out = nested_to_json(df) if fmt == "csv" else df
    writer = out.write.mode(mode).options(**TEXT_TIMES)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(uri)
    elif fmt == "json":
        writer.option("ignoreNullFields", False).json(uri)
    else:
        writer.parquet(uri)
    return uri


def nested_to_json(df: DataFrame) -> DataFrame:
    nested = (T.StructType, T.MapType, T.ArrayType)
    return df.withColumns({
        f.name: F.to_json(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, nested)
    })


def with_snapshot_date(df: DataFrame, dataset: str) -> DataFrame:
    """Add the day partition column of a data set."""
    source = S.PARTITION_SOURCE.get(dataset, "extraction_date")
    if source not in df.columns:
        return df
    return df.withColumn(S.PARTITION_COLUMN, F.to_date(F.col(source)))


def write_bundle(bundle: dict[str, DataFrame], directory: str, fmt: str = "parquet",
                 stamp: str | None = None, strict: bool = True) -> list[dict]:
    """Write every non-empty data set to ``directory/<dataset>/run=<stamp>``; return the manifest.

    With ``strict=False`` a failing data set is recorded and the others still written.
    """
    stamp = stamp or dt.datetime.now(dt.timezone.utc).strftime("%Y%m%d_%H%M%S")

    def write_one(item: tuple[str, DataFrame]) -> dict:
        name, df = item
        uri = f"{directory.rstrip('/')}/{name}/run={stamp}"
        entry = {"data_type": name, "uri": uri, "file_format": fmt, "record_count": 0,
                 "column_count": len(df.columns), "status": "written", "error": None}
        try:
            write_dataset(df, uri, fmt, mode="overwrite")      # one run of the plan; what it made is counted in the files
            entry["record_count"] = readers.read_dataset(
                df.sparkSession, uri, fmt, _stored(df, fmt), multiline=True).count()
            if not entry["record_count"]:
                entry["status"] = "empty"
                _remove(df.sparkSession, uri)
        except Exception as problem:
            if strict:
                raise
            entry["status"], entry["error"] = "failed", _reason(problem)
        return entry

    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:      # small data sets share the cluster
        return list(pool.map(write_one, bundle.items()))


def _stored(df: DataFrame, fmt: str) -> T.StructType:
    return nested_to_json(df).schema if fmt == "csv" else df.schema


def read_bundle(spark: SparkSession, manifest: list[dict], schemas: dict[str, T.StructType] | None = None) -> dict[str, DataFrame]:
    """Read back what a manifest lists as written."""
    return {
        m["data_type"]: readers.read_dataset(
            spark, m["uri"], m["file_format"], (schemas or {}).get(m["data_type"]), multiline=True)
        for m in manifest if m["status"] == "written"
    }


def manifest_frame(spark: SparkSession, manifest: list[dict]) -> DataFrame:
    return spark.createDataFrame([tuple(m[k] for k in (
        "data_type", "uri", "file_format", "record_count", "column_count", "status", "error")) for m in manifest],
        MANIFEST_SCHEMA)


# --- sink coercions ---------------------------------------------------------


def coerce_text_sink(df: DataFrame) -> DataFrame:
    """For text-loading sinks: timestamps as text, booleans as 0/1, null text as ''."""
    out = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.BooleanType):
            out[f.name] = c.cast("int")
        elif isinstance(f.dataType, T.StringType):
            out[f.name] = F.coalesce(c, F.lit(""))
    return df.withColumns(out)


def coerce_string_sink(df: DataFrame) -> DataFrame:
    """For typed sinks: nested columns as JSON text, the text 'nan' as null."""
    plain = nested_to_json(df)
    return plain.withColumns({
        f.name: F.nullif(F.col(f"`{f.name}`"), F.lit("nan"))
        for f in plain.schema.fields if isinstance(f.dataType, T.StringType)
    })


def conform_to_warehouse(df: DataFrame, dataset: str) -> DataFrame:
    """Exact warehouse columns, order and types; absent columns are null, nested ones JSON text.

    Values that do not fit their type become null; ``misfits`` counts them.
    """
    columns = [
        (F.lit(None).cast(f.dataType) if given is None else _fitted(df, given, f)).alias(f.name)
        for f, given in _warehouse_columns(df, dataset)
    ]
    return df.select(*columns)


def _warehouse_columns(df: DataFrame, dataset: str) -> list[tuple[T.StructField, str | None]]:
    """Every warehouse column with the name of the column that fills it."""
    have = {S.warehouse_name(c, dataset): c for c in df.columns}
    return [(f, have.get(f.name)) for f in S.warehouse_schema(dataset).fields]


def _plain(df: DataFrame, name: str) -> Column:
    nested = isinstance(df.schema[name].dataType, (T.StructType, T.MapType, T.ArrayType))
    return F.to_json(F.col(f"`{name}`")) if nested else F.col(f"`{name}`")


def _fitted(df: DataFrame, name: str, field: T.StructField) -> Column:
    c = _plain(df, name)
    return c if df.schema[name].dataType == field.dataType else c.try_cast(field.dataType)


def misfits(df: DataFrame, dataset: str) -> DataFrame:
    """Per warehouse column with any: values lost to its type, and texts longer than it holds.

    Columns: column_name, not_castable, too_long. One pass over the rows.
    """
    tests, names = [], []
    for field, given in _warehouse_columns(df, dataset):
        if given is None:
            continue
        plain, fitted = _plain(df, given), _fitted(df, given, field)
        text = isinstance(field.dataType, T.StringType)
        limit = S.TEXT_LENGTHS.get(field.name, S.TEXT_LENGTH)
        tests.append(F.struct(
            F.lit(field.name).alias("column_name"),
            F.count_if(plain.isNotNull() & fitted.isNull()).alias("not_castable"),
            F.count_if((F.length(fitted) > limit) if text else F.lit(False)).alias("too_long")))
        names.append(field.name)
    if not tests:
        return df.sparkSession.createDataFrame([], "column_name STRING, not_castable BIGINT, too_long BIGINT")
    return df.agg(F.array(*tests).alias("found")).select(F.explode("found").alias("f")).select("f.*").filter(
        "not_castable > 0 OR too_long > 0")


# --- tables -----------------------------------------------------------------


def _reason(problem: Exception) -> str:
    return (str(problem).splitlines() or [type(problem).__name__])[0]


def create_tables(spark: SparkSession, tables=tuple(S.WAREHOUSE_TABLES), prefix: str = "",
                  replace: bool = True, buckets: int | None = None) -> dict[str, str | None]:
    """Create warehouse tables, Parquet partitioned by day and run; ``replace`` drops them first.

    With ``buckets`` the rows of a day are cut into so many by the table's key and sorted by it: windows and joins over this key then
    read the table without a shuffle. Take about one bucket for each 128 MB of a day. Such tables are filled by ``load_table``.
    Returns, per table, null or why it could not be created.
    """
    created: dict[str, str | None] = {}
    for table in tables:
        name = f"{prefix}{table}"
        try:
            if replace:
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            _create(spark, name, T.StructType([
                *S.warehouse_schema(table).fields, T.StructField(S.PARTITION_COLUMN, T.DateType()), T.StructField(S.RUN_COLUMN, T.StringType())]),
                (S.PARTITION_COLUMN, S.RUN_COLUMN), S.CLUSTER_COLUMNS.get(table, ()) if buckets else (), buckets)
            created[name] = None
        except Exception as problem:
            created[name] = _reason(problem)
    return created


def _create(spark: SparkSession, name: str, schema: T.StructType, partition_by=(), bucket_by=(), buckets: int | None = None,
            sort_by=()) -> None:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    listed = lambda columns: ", ".join(f"`{c}`" for c in columns)
    parts = f" PARTITIONED BY ({listed(partition_by)})" if partition_by else ""
    if bucket_by:
        parts += f" CLUSTERED BY ({listed(bucket_by)}) SORTED BY ({listed([*bucket_by, *sort_by])}) INTO {buckets} BUCKETS"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet{parts}")


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """(buckets, columns in the order they are hashed) of a catalog table; (0, []) without."""
    if not any(c.isBucket for c in spark.catalog.listColumns(name)):
        return 0, []
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}      # the table's columns
    return int(told["Num Buckets"]), re.findall("`([^`]+)`", told["Bucket Columns"])


def store_bucketed(df: DataFrame, name: str, keys, buckets: int, order=()) -> DataFrame:
    """Store rows in a new catalog table, cut by ``keys`` into buckets and sorted by keys and ``order``; returns the table.

    Windows by these keys, and joins of two tables with as many buckets of the same keys, need no shuffle of what is stored. There is
    one file per bucket, so that windows need no sort either. Null keys share a bucket. A bucket is one task: for keys that may
    hold a large share of the rows, join with ``joins.join_unique`` instead.
    """
    spark = df.sparkSession
    _create(spark, name, df.schema, bucket_by=keys, buckets=buckets, sort_by=order)
    df.repartition(buckets, *keys).write.mode("overwrite").insertInto(name)
    return spark.table(name)


def load_table(df: DataFrame, name: str, if_exists: str = "append", partition_by=()) -> None:
    """Append to, replace, or create (failing if present) a catalog table."""
    mode = _MODES[if_exists]
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name):
        columns = spark.table(name).columns
        if S.RUN_COLUMN in columns and S.RUN_COLUMN not in df.columns:
            df = df.withColumn(S.RUN_COLUMN, F.lit(None).cast("string"))      # loaded outside of any run
        buckets, keys = bucketing(spark, name)
        if buckets:      # one file for each bucket of a day; a hot key is spread over its days
            days = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
            df = df.repartition(F.pmod(F.hash(*keys), F.lit(buckets)), *days)
        df.select(*columns).write.mode("append").insertInto(name)
        return
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def load_run(df: DataFrame, name: str, run_id: str, partition_by=()) -> None:
    """Put the rows of a run in a table, in place of whatever the same run has loaded before.

    The run is a partition beside ``partition_by`` (at most a day). Its files are staged and then replace exactly the partitions
    of this run; days it no longer has are dropped. So a load may be repeated, or be cut off and repeated, and the table holds the run
    once; other runs are not touched. Without rows, the run's partitions go. The table is created if it is missing.
    """
    spark = df.sparkSession
    keys = (*partition_by, S.RUN_COLUMN)
    rows = df.withColumn(S.RUN_COLUMN, F.lit(run_id))
    _create(spark, name, rows.select(*[c for c in rows.columns if c not in keys], *keys).schema, keys)
    stored = spark.table(name)
    if S.RUN_COLUMN not in stored.columns:
        raise ValueError(f"{name} has no column {S.RUN_COLUMN}: it cannot tell runs apart")
    if bucketing(spark, name)[0]:
        raise ValueError(f"{name} has buckets, which files put beside them would break: use load_table")
    rows = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in stored.schema.fields])
    place, = [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()]
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(place)

    fresh = [{c: r[c] for c in keys} for r in rows.select(*[F.col(c).cast("string") for c in keys]).distinct().collect()]      # one a day
    days = {tuple(values[c] for c in partition_by) for values in fresh}
    for values in _partitions(spark, f"{name} PARTITION ({_spec({S.RUN_COLUMN: run_id})})"):
        if tuple(values[c] for c in partition_by) not in days:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_spec({**values, S.RUN_COLUMN: run_id})})")
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({_spec(values)})" for values in fresh))
    spark.catalog.refreshTable(name)


_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"      # fixed value: the folder of a null partition


def _partitions(spark: SparkSession, name: str) -> list[dict[str, str | None]]:
    """Partitions of a catalog table, a few a day, as column and text (escaped as in folder names)."""
    listed = (dict(part.split("=", 1) for part in r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    return [{c: None if v == _NO_VALUE else v for c, v in values.items()} for values in listed]


def _spec(values: dict[str, str | None]) -> str:
    return ", ".join(f"`{c}` = {_quoted(v)}" for c, v in values.items())


def _quoted(value: str | None) -> str:
    if value is None:
        return "null"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def load_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append", **options: str) -> None:
    """Load into a database over JDBC in batches, one connection per partition."""
    (df.write.format("jdbc").mode(_MODES[if_exists])
     .options(url=url, dbtable=table, batchsize=str(JDBC_BATCH), **options).save())


def clustered(df: DataFrame, dataset: str) -> DataFrame:
    """Warehouse rows with their day, sorted within each task by day and key.

    The local sort is the one a partitioned write needs anyway; it narrows the value
    ranges of the stored row groups, so filters on the key can skip them.
    """
    rows = with_snapshot_date(conform_to_warehouse(df, dataset), dataset)
    return rows.sortWithinPartitions(S.PARTITION_COLUMN, *S.CLUSTER_COLUMNS.get(dataset, ()))


def load_tables(bundle: dict[str, DataFrame], prefix: str = "", if_exists: str = "append",
                run_id: str | None = None) -> dict[str, str | None]:
    """Load every data set into ``prefix + name``, conformed, several side by side.

    Returns, per table, null or why it could not be loaded; the others are loaded anyway. Give it
    stored data sets: then looking whether one is empty costs next to nothing; empty ones are left out. With ``run_id``
    rows are appended as those of that run, so that the load may be repeated (``load_run``).
    """
    def load_one(item: tuple[str, DataFrame]) -> tuple[str, str | None] | None:
        dataset, df = item
        name = f"{prefix}{dataset}"
        days = (S.PARTITION_COLUMN,) if dataset in S.WAREHOUSE_TABLES else ()
        try:
            repeated = run_id is not None and if_exists == "append"
            if is_empty(df) and not (repeated and df.sparkSession.catalog.tableExists(name)):
                return None
            rows = clustered(df, dataset) if days else df
            if repeated:
                load_run(rows, name, run_id, days)
            else:
                load_table(rows, name, if_exists, days)
            return name, None
        except Exception as problem:
            return name, _reason(problem)

    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        return dict(x for x in pool.map(load_one, bundle.items()) if x)


def content_digest(df: DataFrame, by=()) -> DataFrame:
    """``by``, record_count and digest: the sum of a hash of each row, whatever the order of rows and files.

    A null is told from an absent neighbour, so values that change places in a row or between rows change the sum.
    """
    rows = dedup.comparable(df)
    cells = [x for c in rows.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("record_count"),
                                 F.coalesce(F.sum(F.xxhash64(*cells).cast("decimal(28,0)")), F.lit(0)).alias("digest"))


def reconcile_content(actual: DataFrame, expected: DataFrame, by=()) -> DataFrame:
    """Per group of ``by``: expected_count, actual_count, count_match and content_match, from two sums over each side.

    Columns of both sides are compared by name in the order and types of ``expected``. One changed cell, a swap between rows or a row
    in place of another shows, though counts agree. Only a row of sums per group and task is shuffled.
    """
    typed = actual.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in expected.schema.fields])
    both = content_digest(expected, by).withColumn("side", F.lit("expected")).unionByName(
        content_digest(typed, by).withColumn("side", F.lit("actual")))
    of = lambda side, c: F.coalesce(F.max(F.when(F.col("side") == side, F.col(c))), F.lit(0))
    return both.groupBy(*by).agg(
        of("expected", "record_count").alias("expected_count"), of("actual", "record_count").alias("actual_count"),
        of("expected", "digest").alias("expected_digest"), of("actual", "digest").alias("actual_digest"),
    ).withColumns({
        "count_match": F.col("expected_count") == F.col("actual_count"),
        "content_match": (F.col("expected_count") == F.col("actual_count")) & (F.col("expected_digest") == F.col("actual_digest")),
    })


def reconcile_load(actual: DataFrame, expected: DataFrame, key: str = "table_name") -> DataFrame:
    """Compare counts per table (or batch): ``expected`` has key and ``expected_count``."""
    counted = actual.groupBy(key).agg(F.count(F.lit(1)).alias("actual_count"))
    both = expected.select(key, "expected_count").join(counted, key, "left")
    found = F.coalesce("actual_count", F.lit(0))
    message = F.concat(F.lit("expected "), F.col("expected_count").cast("string"),
                       F.lit(" records, found "), F.col("actual_count").cast("string"))
    return (
        both.withColumn("actual_count", found)
        .withColumn("count_match", F.col("actual_count") == F.col("expected_count"))
        .withColumn("is_valid", F.col("count_match"))
        .withColumn("errors", F.when(~F.col("count_match"), message))
    )


def table_info(spark: SparkSession, name: str) -> DataFrame:
    """Row count and stored bytes of a table (one row)."""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    details = spark.sql(f"DESCRIBE EXTENDED {name}")
    size = details.filter(F.col("col_name") == "Statistics").select(
        F.regexp_extract("data_type", r"(\d+) bytes", 1).try_cast("bigint")).scalar()
    return spark.table(name).agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(name).alias("table_name"), "record_count", size.alias("size_bytes"))


def run_sql(spark: SparkSession, sql: str, params: dict | None = None, **tables: DataFrame) -> DataFrame:
    """Run SQL with named parameters (``:name``); every statement returns its result.

    DataFrames given by keyword can be used in the text as ``{keyword}``.
    """
    return spark.sql(sql, args=params or {}, **tables)


def upsert_table(spark: SparkSession, path: str, new: DataFrame, keys, order,
                 partition: str = S.PARTITION_COLUMN) -> list:
    """Merge ``new`` into partitioned Parquet; a key is stored once, wherever it was before.

    Partitions are rewritten that ``new`` touches or that hold a key of ``new`` (for the latter only
    the key columns of the table are read); a partition that all its keys have left is removed. The batch
    and the merged rows are checkpointed in the shared folder first: the batch so that the
    touched partitions and the merge see the same rows, the result so that a lost executor
    cannot lead back to partitions that are already replaced. Null keys and null partitions
    count as values. Returns the touched partitions.
    """
    ensure_checkpoint_dir(spark)
    new = new.checkpoint()
    stored = spark.read.parquet(path)
    fresh = new.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    homes = stored.join(fresh, same, "left_semi").select(partition)
    touched = [r[0] for r in new.select(partition).unionByName(homes).distinct().collect()]     # one value per day
    merge_partitions(spark, path, new, touched, keys, order, partition)
    return touched


def merge_partitions(spark: SparkSession, path: str, new: DataFrame, touched: list, keys, order, partition: str) -> DataFrame:
    """Merge ``new`` into the given partitions of a table and replace them; returns their rows, checkpointed.

    No other partition is read. Partitions without any row left are removed.
    """
    stored = spark.read.parquet(path)
    days = [d for d in touched if d is not None]
    in_touched = F.col(partition).isin(days) if days else F.lit(False)
    if None in touched:
        in_touched = in_touched | F.col(partition).isNull()
    merged = dedup.upsert_latest(stored.filter(in_touched), new, keys, order).select(*stored.columns).checkpoint()
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    left = {r[0] for r in merged.select(partition).distinct().collect()}
    for value in touched:
        if value not in left:
            _remove(spark, f"{path}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
    return merged


def _remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def drop_expired(spark: SparkSession, table: str, days: int, as_of, column: str = S.PARTITION_COLUMN) -> list[str]:
    """Drop day partitions older than ``days`` days from a catalog table."""
    oldest = dt.date.fromisoformat(str(as_of)[:10]) - dt.timedelta(days=days)
    expired = []
    for values in _partitions(spark, table):
        day = values[column]
        if day and day[:4].isdigit() and dt.date.fromisoformat(day) < oldest:
            whole = {c: v if v is None else unquote(v) for c, v in values.items()}
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({_spec(whole)})")
            expired.append(day)
    return sorted(set(expired))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files under a path: name, bytes, modification time. File contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(F.col("path").alias("key"), F.col("length").alias("size"),
                F.col("modificationTime").alias("last_modified"))
    )


def storage_info(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.count(F.lit(1)).alias("total_objects"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("total_size_bytes"),
        F.max("last_modified").alias("last_modified"),
    )


def write_quality(results: DataFrame, table: str, as_of=None, expected: dict[str, int] | None = None) -> None:
    """Append validation results to the data quality table."""
    load_table(with_snapshot_date(quality_rows(results, as_of, expected), "data_quality"), table, "append",
               (S.PARTITION_COLUMN,))


def quality_rows(results: DataFrame, as_of=None, expected: dict[str, int] | None = None) -> DataFrame:
    """Validation results in the shape of the data quality table.

    ``expected`` has the number of rows each data set should have, as a manifest tells it; where
    it is unknown, the expected count and whether it matches are null.
    """
    known = F.lit(None).cast("bigint")
    for dataset, count in (expected or {}).items():
        known = F.when(F.col("dataset") == dataset, F.lit(count).cast("bigint")).otherwise(known)
    shaped = results.select(
        F.col("dataset").alias("table_name"), "validation_timestamp", "record_count",
        known.alias("expected_count"), (known == F.col("record_count")).alias("count_match"), "is_valid",
        "quality_score", F.to_json("errors").alias("errors"), F.to_json("warnings").alias("warnings"),
        F.to_json("null_percentages").alias("null_percentages"), "duplicate_percentage",
        F.col("estimated_mb").alias("memory_usage_mb"),
        (F.col("validation_timestamp") if as_of is None else F.lit(str(as_of)).cast("timestamp")).alias("extraction_date"),
    )
    return conform_to_warehouse(shaped, "data_quality")


RUN_LOG_SCHEMA = (
    "execution_id STRING, execution_date TIMESTAMP, task_name STRING, status STRING, start_time TIMESTAMP, "
    "end_time TIMESTAMP, duration_seconds INT, records_processed BIGINT, error_message STRING, created_at TIMESTAMP"
)


def run_log(spark: SparkSession, steps: list[dict], execution_id: str | None = None) -> DataFrame:
    """Execution log rows from the driver's step records."""
    execution_id = execution_id or f"manual_{uuid.uuid4().hex[:12]}"
    now = dt.datetime.now(dt.timezone.utc)
    first = min((s["start_time"] for s in steps), default=now)
    return spark.createDataFrame([
        (execution_id, first, s["task_name"], s["status"], s["start_time"], s["end_time"],
         int((s["end_time"] - s["start_time"]).total_seconds()), s.get("records_processed"),
         s.get("error_message"), now)
        for s in steps
    ], RUN_LOG_SCHEMA)
