"""The logical tables of the engine, derived from the star-schema test tables.

* ``snapshot``: one row per customer as a region; its orders are the cases, order
  status splits them into outcomes.
* ``history``: one row per user, event type and day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstats.functions import columns as C
from snapstats.operators import clean
from snapstats.plans import transforms

# Clocks of the two table groups, and the metric each event type stands for.
SNAPSHOT_AS_OF = "2001-08-02 12:00:00"
HISTORY_AS_OF = "2024-01-31 00:00:00"
EVENT_METRICS = {"view": "cases", "click": "deaths", "purchase": "recovered"}


# Schemas of the test tables; stating them saves a footer-reading job per table.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions with raw counts. Orders are reduced per customer before any join."""
    status = lambda s: F.count_if(F.col("o_orderstatus") == s)
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("cases"), status("F").alias("deaths"), status("O").alias("recovered"),
        status("P").alias("active"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("tests"),
        F.max("o_orderdate").alias("updated"))
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("continent"))
    )
    regions = table(spark, sf_dir, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return regions.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("country"), "continent",
        *[zero(c) for c in ("cases", "deaths", "recovered", "active", "tests")],
        F.col("c_acctbal").cast("bigint").alias("population"), "updated",
        F.date_trunc("quarter", "updated").alias("extraction_date"),
        F.col("c_mktsegment").alias("data_source"), F.lit("countries").alias("data_type"))


def rated_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.with_rates(snapshot(spark, sf_dir), "countries")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long series: events counted per user, day and type - one row per series and day."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(
        F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("country"),
        F.col("ts").cast("date").alias("date"), F.col("event_type").alias("metric"),
    ).agg(F.count(F.lit(1)).alias("value")).select(
        "date", C.mapped("metric", EVENT_METRICS).alias("metric"), "value", "country")


def global_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counted over all users, as the 'Global' series."""
    events = table(spark, sf_dir, "events")
    return events.groupBy(F.col("ts").cast("date").alias("date"), F.col("event_type").alias("metric")).agg(
        F.count(F.lit(1)).alias("value")).select(
        "date", C.mapped("metric", EVENT_METRICS).alias("metric"), "value", F.lit("Global").alias("country"))


def history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.transform_series(history(spark, sf_dir))
