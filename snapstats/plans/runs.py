"""A whole run: read, keep raw, transform, validate, keep processed, load, reconcile, log."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstats import schemas as S
from snapstats.plans import quality, transforms
from snapstats.sources import readers, writers

log = logging.getLogger(__name__)

FEW_RECORDS = 10
STEPS = ("extract", "transform", "store", "load")
CORE_STEPS = ("extract", "transform")


def run_steps(spark: SparkSession, landing: str, out: str, as_of, step: str = "all", skip=(),
              prefix: str = "stats_", include_history: bool = True, days: int | str | None = 30,
              datasets=S.SNAPSHOT_DATASETS + ("vaccines",), execution_id: str | None = None, lines: bool = False,
              log_table: str | None = None, quality_table: str | None = None) -> dict:
    """Run all steps, or one.

    Steps hand data on through the files they wrote, so each can also run alone and a
    lost executor never forces an earlier step to run again. A failed core step stops
    the run; a step of which only some data sets went wrong is 'partial', and so is then the
    run; ``skip`` leaves out 'store' or 'load'. Loading puts the run's rows in place of those the same run has loaded
    before, so a step may be repeated under its ``execution_id``, and reconciles every table with the manifest.
    Returns status, manifests, load results, reconciliation and step records; the records are
    also written to ``out/run_log``, and step records and validation results to ``log_table``
    and ``quality_table`` if named. What could not be read is under ``out/rejects``.
    """
    run_id = execution_id or f"manual_{uuid.uuid4().hex[:12]}"
    wanted = STEPS if step == "all" else (step,)
    if not set(wanted) <= set(STEPS):
        raise ValueError(f"unknown step: {step}")
    result: dict = {"execution_id": run_id, "status": "success", "steps": []}
    jobs = {
        "extract": lambda: _extract(spark, landing, out, as_of, run_id, include_history, days, datasets, lines),
        "transform": lambda: _transform(spark, out, as_of, run_id, quality_table),
        "store": lambda: _store(spark, out, run_id),
        "load": lambda: _load(spark, out, as_of, run_id, prefix),
    }
    for name in wanted:
        started = dt.datetime.now(dt.timezone.utc)
        record = {"task_name": name, "status": "success", "start_time": started}
        if name in skip:
            record["status"] = "skipped"
        else:
            try:
                outcome, record["records_processed"], problems = jobs[name]()
                result.update(outcome)
                if problems:
                    whole = record["records_processed"] == 0
                    record.update(status="failed" if whole else "partial", error_message="; ".join(problems))
                    result["status"] = "partial"
            except Exception as problem:
                record.update(status="failed", error_message=str(problem).splitlines()[0])
                if name in CORE_STEPS:
                    result["status"] = "failed"
        record["end_time"] = dt.datetime.now(dt.timezone.utc)
        result["steps"].append(record)
        if result["status"] == "failed":
            break
    rows = writers.run_log(spark, result["steps"], run_id)
    rows.coalesce(1).write.mode("append").json(f"{out}/run_log")
    if log_table:
        stored = writers.with_snapshot_date(writers.conform_to_warehouse(rows, "pipeline_log"), "pipeline_log")
        writers.load_table(stored, log_table, "append", (S.PARTITION_COLUMN,))
    return result


def _manifest(spark: SparkSession, out: str, stage: str, run_id: str) -> list[dict]:
    listed = spark.read.schema(writers.MANIFEST_SCHEMA).json(f"{out}/manifests/{stage}/run={run_id}")
    return [r.asDict() for r in listed.collect()]      # one row per data set


def _stage(spark: SparkSession, out: str, stage: str, run_id: str) -> dict[str, DataFrame]:
    """Data sets a stage of this run has written."""
    return writers.read_bundle(spark, _manifest(spark, out, stage, run_id))


def _keep(spark: SparkSession, bundle: dict[str, DataFrame], out: str, stage: str, run_id: str):
    manifest = writers.write_bundle(bundle, f"{out}/{stage}", "parquet", run_id, strict=False)
    writers.manifest_frame(spark, manifest).coalesce(1).write.mode("overwrite").json(
        f"{out}/manifests/{stage}/run={run_id}")
    return manifest, sum(m["record_count"] for m in manifest), _failures(manifest)


def _failures(manifest: list[dict]) -> list[str]:
    return [f"{m['data_type']}: {m['error']}" for m in manifest if m["status"] == "failed"]


def _extract(spark, landing, out, as_of, run_id, include_history, days, datasets, lines):
    bundle = readers.read_all(
        spark, landing, as_of, include_history=include_history, days=days, datasets=datasets, lines=lines)
    manifest, records, problems = _keep(spark, bundle, out, "raw", run_id)
    for entry in manifest:
        if entry["record_count"] < FEW_RECORDS:
            log.warning("data set %s has %d records", entry["data_type"], entry["record_count"])
    if not any(m["status"] == "written" for m in manifest):
        raise ValueError("; ".join(["no data sets were extracted", *problems]))
    rejected = {
        m["data_type"]: readers.read_rejects(spark, f"{landing}/{m['data_type']}", m["data_type"], lines)
        for m in manifest if m["status"] != "failed"}
    refused = writers.write_bundle(rejected, f"{out}/rejects", "json", run_id, strict=False)
    for entry in refused:
        if entry["record_count"]:
            log.warning("data set %s: %d records could not be read", entry["data_type"], entry["record_count"])
    return {"extract": manifest, "rejects": refused}, records, problems + _failures(refused)


def _transform(spark, out, as_of, run_id, quality_table):
    raw = _stage(spark, out, "raw", run_id)
    data, _ = transforms.transform_all(raw, as_of, validate=False)
    manifest, records, problems = _keep(spark, data, out, "processed", run_id)
    # Validation reads the stored result: one computation, and exactly what was kept.
    for dataset, df in _stage(spark, out, "processed", run_id).items():
        row = quality.validated(df, dataset, as_of)
        row.coalesce(1).write.mode("append").json(f"{out}/quality/run={run_id}")
        if quality_table:
            expected = {m["data_type"]: m["record_count"] for m in manifest}
            writers.write_quality(row, quality_table, as_of, expected)
    return {"transform": manifest, "removed": transforms.removed_counts(raw, manifest)}, records, problems


def _store(spark, out, run_id):
    stored = _stage(spark, out, "processed", run_id)
    manifest = writers.write_bundle(stored, f"{out}/store", "parquet", run_id, strict=False)
    return {"store": manifest}, sum(m["record_count"] for m in manifest), _failures(manifest)


def _load(spark, out, as_of, run_id, prefix):
    """Load what was processed as this run's rows, then compare each loaded table with the manifest."""
    manifest = _manifest(spark, out, "processed", run_id)
    loaded = writers.load_tables(writers.read_bundle(spark, manifest), prefix, "append", run_id)
    good = [m for m in manifest if m["status"] == "written" and loaded.get(f"{prefix}{m['data_type']}", "absent") is None]
    checked = [r.asDict() for r in reconcile(spark, good, prefix, as_of, run_id).collect()] if good else []      # one row per table
    problems = [f"{name}: {why}" for name, why in loaded.items() if why]
    problems += [f"{r['table_name']}: {r['errors']}" for r in checked if not r["is_valid"]]
    return {"load": loaded, "reconcile": checked}, sum(m["record_count"] for m in good), problems


def reconcile(spark: SparkSession, manifest: list[dict], prefix: str, stamp, run_id: str | None = None) -> DataFrame:
    """Rows of this run's extraction found in each table against the manifest's counts.

    Only rows with this run's ``extraction_date`` count, and only those it loaded if ``run_id`` is given, so appending
    to a table that already holds earlier runs still reconciles.
    """
    at = F.lit(str(stamp)).cast("timestamp")
    written = [m for m in manifest if m["status"] == "written"]
    actual = None
    for m in written:
        table = f"{prefix}{m['data_type']}"
        rows = spark.table(table).filter(F.col("extraction_date") == at)
        if m["data_type"] not in S.PARTITION_SOURCE:      # partitioned by extraction day: prune
            rows = rows.filter(F.col(S.PARTITION_COLUMN) == at.cast("date"))
        if run_id is not None:
            rows = rows.filter(F.col(S.RUN_COLUMN) == run_id)
        rows = rows.select(F.lit(table).alias("table_name"))
        actual = rows if actual is None else actual.unionByName(rows)
    expected = spark.createDataFrame(
        [(f"{prefix}{m['data_type']}", m["record_count"]) for m in written], "table_name STRING, expected_count BIGINT")
    return writers.reconcile_load(actual, expected)


def run_summary(manifest: DataFrame, log: DataFrame) -> DataFrame:
    """One row: records, data sets and steps of a run."""
    stored = manifest.filter(F.col("status") == "written").agg(
        F.count(F.lit(1)).alias("datasets"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"))
    steps = lambda state: log.filter(F.col("status") == state).agg(F.count(F.lit(1))).scalar()
    return stored.withColumns({
        "steps_succeeded": steps("success"), "steps_partial": steps("partial"), "steps_failed": steps("failed"),
        "duration_seconds": log.agg(F.coalesce(F.sum("duration_seconds"), F.lit(0))).scalar(),
    })
