"""Incremental ingestion of landing files with Structured Streaming.

The daily schedule becomes ``availableNow``: a run takes every landing file that has
not been processed yet, then stops; the checkpoint keeps one run from repeating another.
Micro-batches only parse, type and append rows. What looks beyond a row - medians, duplicates,
changes, means - runs over the stored rows afterwards, so the answer does not depend on how
files fall into batches. Histories look back only as far as their windows do (``tail``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from snapstats import schemas as S
from snapstats.plans import transforms
from snapstats.sources import readers, writers
from snapstats.streaming import tail

BATCH_COLUMN = "batch_id"
MAX_FILES = 1000      # files a micro-batch takes; a limit on its size, not on the result


def landing_stream(spark: SparkSession, path: str, dataset: str, max_files: int = MAX_FILES,
                   lines: bool = False) -> DataFrame:
    """New landing documents of a data set as a stream, read as ``readers.landing`` reads them."""
    return readers.landing(spark.readStream.option("maxFilesPerTrigger", max_files), path, dataset, lines)


def parquet_stream(spark: SparkSession, directory: str, like: DataFrame, max_files: int = MAX_FILES,
                   glob: str = "*.parquet") -> DataFrame:
    """New Parquet files of a folder as a stream, with the schema of a batch frame."""
    return (
        spark.readStream.schema(like.schema).option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", glob).parquet(directory)
    )


def write_batches(stream: DataFrame, out: str, checkpoint: str, *steps, partition_by=()) -> StreamingQuery:
    """Store what each (folder, step) makes of every micro-batch, under its batch id.

    A batch that is retried after a failure replaces its own folder, so the sink holds
    every batch exactly once. A single function stands for a step into ``out`` itself.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        for step in steps:
            folder, made = ("", step) if callable(step) else step
            writers.write_dataset(made(batch), f"{out}{folder}/{BATCH_COLUMN}={batch_id}", mode="overwrite", partition_by=partition_by)

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def ingest_available_now(spark: SparkSession, landing: str, dataset: str, out: str, checkpoint: str,
                         as_of=None, lines: bool = False, max_files: int = MAX_FILES) -> DataFrame:
    """Append whatever is new for a data set, then bring its published rows up to date.

    Typed rows go to ``out/rows``, records that could not be read to ``out/rejects``, and the transformed
    data set to ``out/data``, which is returned. A run that ends between the two steps is made good
    by the next one: batches count as published only once the data is written.
    """
    clock = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)      # one for the whole run
    write_batches(
        landing_stream(spark, landing, dataset, max_files, lines), out, checkpoint,
        ("/rows", lambda batch: readers.from_payload(batch, dataset, clock)),
        ("/rejects", lambda batch: readers.rejected(batch, dataset))).awaitTermination()
    return publish(spark, dataset, out, clock)


def publish(spark: SparkSession, dataset: str, out: str, as_of) -> DataFrame:
    """Transform what batches not yet published touch: their extractions, or their series.

    A snapshot's extraction is transformed from all its rows. Of a history only the new rows are read; their windows look
    back into the stored tails of the series (``tail``).
    """
    marks, data = f"{out}/published", f"{out}/data"
    done = spark.read.schema(f"{BATCH_COLUMN} INT").json(marks) if _exists(spark, marks) else None
    rows = spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows")
    new = rows if done is None else rows.join(done, BATCH_COLUMN, "left_anti")
    fresh = [r[0] for r in new.select(BATCH_COLUMN).distinct().collect()]      # one value per batch
    if fresh:
        if dataset in S.SERIES_DATASETS:
            points = transforms.transform_points(new.drop(BATCH_COLUMN), as_of)
            tail.advance(spark, points, out, [c for c in ("extraction_date", S.SEQUENCE_COLUMN) if c in points.columns])
        else:
            stored = rows.drop(BATCH_COLUMN)
            for row in new.select("extraction_date").distinct().collect():      # one per run
                one = stored.filter(F.col("extraction_date").eqNullSafe(F.lit(row[0])))
                done_rows = transforms.transform(one, dataset, as_of).withColumn(
                    S.PARTITION_COLUMN, F.to_date("extraction_date")).withColumn("extraction", F.col("extraction_date").cast("string"))
                done_rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                    S.PARTITION_COLUMN, "extraction").parquet(data)
        spark.createDataFrame([(b,) for b in fresh], f"{BATCH_COLUMN} INT").coalesce(1).write.mode("append").json(marks)
    return tail.stored(spark, out).drop(S.SEQUENCE_COLUMN)


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
