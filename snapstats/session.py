"""Spark session with the settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps epoch arithmetic and calendar parts stable; AQE coalesces small
# shuffle partitions and splits skewed join partitions at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(app: str = "snapstats", master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster, else ``fallback`` (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(folder)
    return folder
