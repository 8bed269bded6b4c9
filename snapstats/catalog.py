"""Every operator as a query over the test tables, beside the SQL it must agree with.

Dates and times leave as text so that engines print them alike. Columns come from the
library; the bindings in ``bind`` only give the tables their logical names.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapstats import bind, schemas as S
from snapstats.functions import columns as C
from snapstats.operators import clean, dedup, quantiles, ranks, series
from snapstats.plans import checks, completeness, quality, reports, runs, transforms
from snapstats.session import ensure_checkpoint_dir
from snapstats.sources import drift, homes, intervals, readers, writers
from snapstats.streaming import ingest, tail

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

NOW_S = f"TIMESTAMP '{bind.SNAPSHOT_AS_OF}'"
NOW_H = f"TIMESTAMP '{bind.HISTORY_AS_OF}'"

# --- shared SQL: the logical tables ---------------------------------------------

SNAPSHOT = """
counts AS (
  SELECT o_custkey, count(*) AS cases, count(*) FILTER (o_orderstatus = 'F') AS deaths,
         count(*) FILTER (o_orderstatus = 'O') AS recovered, count(*) FILTER (o_orderstatus = 'P') AS active,
         count(*) FILTER (o_orderpriority = '1-URGENT') AS tests, max(o_orderdate) AS updated
  FROM orders GROUP BY o_custkey),
snapshot AS (
  SELECT c_name AS country, r_name AS continent, coalesce(cases, 0) AS cases, coalesce(deaths, 0) AS deaths,
         coalesce(recovered, 0) AS recovered, coalesce(active, 0) AS active, coalesce(tests, 0) AS tests,
         CAST(trunc(c_acctbal) AS BIGINT) AS population, CAST(updated AS TIMESTAMP) AS updated,
         CAST(date_trunc('quarter', updated) AS TIMESTAMP) AS extraction_date,
         c_mktsegment AS data_source, 'countries' AS data_type
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN counts ON c_custkey = o_custkey)"""

RATED = SNAPSHOT + """,
rated AS (
  SELECT *, CASE WHEN cases > 0 THEN deaths / cases ELSE 0 END AS mortality_rate,
         CASE WHEN cases > 0 THEN recovered / cases ELSE 0 END AS recovery_rate,
         CASE WHEN cases > 0 THEN active / cases ELSE 0 END AS active_rate,
         CASE WHEN population > 0 THEN cases / population * 1000000 ELSE 0 END AS cases_per_million,
         CASE WHEN population > 0 THEN deaths / population * 1000000 ELSE 0 END AS deaths_per_million
  FROM snapshot)"""

_METRIC = "CASE event_type WHEN 'view' THEN 'cases' WHEN 'click' THEN 'deaths' WHEN 'purchase' THEN 'recovered' ELSE event_type END"

HISTORY = f"""
history AS (
  SELECT CAST(ts AS DATE) AS date, {_METRIC} AS metric, count(*) AS value,
         'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS country
  FROM events GROUP BY ALL)"""

GLOBAL_HISTORY = f"""
history AS (
  SELECT CAST(ts AS DATE) AS date, {_METRIC} AS metric, count(*) AS value, 'Global' AS country
  FROM events GROUP BY ALL)"""

GAPPY = """
gappy AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey % 7 END AS cases,
         CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey % 5 END AS deaths,
         CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_totalprice END AS price_rate,
         nullif(o_orderstatus, 'F') AS country, nullif(o_orderpriority, '5-LOW') AS note
  FROM orders)"""

CHANGES = HISTORY + """,
changes AS (
  SELECT *, CAST(value - lag(value) OVER w AS BIGINT) AS daily_change,
         value / nullif(lag(value) OVER w, 0) - 1 AS daily_change_pct
  FROM history WINDOW w AS (PARTITION BY country, metric ORDER BY date))"""


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with nulls injected by rule."""
    mod = lambda n: F.nullif(F.col("o_custkey") % n, F.lit(0).cast("bigint"))
    return bind.table(spark, sf, "orders").select(
        "o_orderkey", mod(7).alias("cases"), mod(5).alias("deaths"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_totalprice")).alias("price_rate"),
        F.nullif("o_orderstatus", F.lit("F")).alias("country"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("note"))


def plain(df: DataFrame) -> DataFrame:
    """Dates and times as text."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            out[f.name] = F.col(f.name).cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(out)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


def scratch(spark: SparkSession) -> str:
    """A fresh folder: in the cluster's shared folder, or a temporary one in local tests."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def query(sql: str | None = None, name: str | None = None):
    def register(function: Query) -> Query:
        key = name or function.__name__

        def run(spark: SparkSession, sf: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(function(spark, sf))

        run.__name__ = key
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql.strip()
        return function
    return register


def ts_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


# --- projection, cast, cleaning -------------------------------------------------


@query(f"WITH {RATED} SELECT country, mortality_rate, recovery_rate, active_rate, cases_per_million, "
       "deaths_per_million FROM rated")
def rates_snapshot(spark, sf):
    return bind.rated_snapshot(spark, sf).select(
        "country", "mortality_rate", "recovery_rate", "active_rate", "cases_per_million", "deaths_per_million")


@query(f"""WITH {SNAPSHOT} SELECT country, deaths / CASE WHEN cases = 0 THEN 1 ELSE cases END AS mortality_rate,
  recovered / CASE WHEN cases = 0 THEN 1 ELSE cases END AS recovery_rate FROM snapshot""")
def rates_simple(spark, sf):
    return clean.with_rates(bind.snapshot(spark, sf), "countries", zero="one").select(
        "country", "mortality_rate", "recovery_rate")


@query(f"""WITH {SNAPSHOT} SELECT country, cases / nullif(population, 0) * 100000 AS cases_per_100k,
  deaths / nullif(population, 0) * 100000 AS deaths_per_100k,
  tests / nullif(population, 0) * 100000 AS tests_per_100k FROM snapshot""")
def per_100k(spark, sf):
    return clean.with_per_100k(bind.snapshot(spark, sf)).select(
        "country", "cases_per_100k", "deaths_per_100k", "tests_per_100k")


@query("""SELECT p_partkey AS part_key, p_name AS todaycases_x, p_brand AS brand_name, p_size AS size FROM part""")
def standardize_names(spark, sf):
    odd = bind.table(spark, sf, "part").select(
        F.col("p_partkey").alias("Part  Key"), F.col("p_name").alias("todayCases.X"),
        F.col("p_brand").alias("__Brand--Name_"), F.col("p_size").alias("size"))
    return clean.standardize_names(odd)


@query(f"WITH {GAPPY} SELECT o_orderkey, coalesce(cases, 0) AS cases, coalesce(deaths, 0) AS deaths FROM gappy")
def fill_counts(spark, sf):
    return clean.fill_counts(gappy(spark, sf)).select("o_orderkey", "cases", "deaths")


@query(f"""WITH {GAPPY} SELECT o_orderkey, round(coalesce(price_rate, (SELECT median(price_rate) FROM gappy)), 6)
  AS price_rate FROM gappy""")
def fill_rates_median(spark, sf):
    return rounded(clean.fill_rates_with_median(gappy(spark, sf)).select("o_orderkey", "price_rate"), "price_rate")


@query(f"""WITH {GAPPY} SELECT o_orderkey, coalesce(country, 'Unknown') AS country, coalesce(note, 'N/A') AS note
  FROM gappy""")
def fill_strings(spark, sf):
    return clean.fill_strings(gappy(spark, sf)).select("o_orderkey", "country", "note")


@query("SELECT c_custkey, c_acctbal, 0 AS cases, 0 AS active FROM customer")
def ensure_columns(spark, sf):
    return clean.ensure_columns(
        bind.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "cases", "active"])


@query("""SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE) AS cases,
  TRY_CAST(p_name AS DOUBLE) AS deaths, p_type AS label FROM part""")
def coerce_numeric(spark, sf):
    return clean.coerce_numerics(bind.table(spark, sf, "part").select(
        "p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("cases"), F.col("p_name").alias("deaths"),
        F.col("p_type").alias("label")))


@query("""SELECT event_id, strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S') AS updated,
  strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS date,
  CAST(NULL AS VARCHAR) AS bad_date FROM events""")
def coerce_timestamp(spark, sf):
    return clean.coerce_timestamps(bind.table(spark, sf, "events").select(
        "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("updated"),
        F.date_format("ts", "M/d/yy").alias("date"), F.col("event_type").alias("bad_date")))


@query("""SELECT event_id, strftime(epoch_ms(epoch_us(ts) // 1000), '%Y-%m-%d %H:%M:%S') AS updated,
  epoch_us(ts) // 1000 AS updated_ms FROM events""")
def epoch_ms(spark, sf):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return clean.epoch_ms_to_ts(bind.table(spark, sf, "events").select(
        "event_id", millis.cast("string").alias("updated"), millis.alias("updated_ms")))


@query("""SELECT p_partkey, coalesce(TRY_CAST(split_part(p_brand, '#', 2) AS DOUBLE), 0) AS cases,
  coalesce(TRY_CAST(p_name AS DOUBLE), 0) AS deaths, p_size AS active FROM part""")
def clean_numeric(spark, sf):
    return clean.clean_numeric(bind.table(spark, sf, "part").select(
        "p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("cases"), F.col("p_name").alias("deaths"),
        F.col("p_size").alias("active")))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS country_k, event_type FROM events")
def flatten_json(spark, sf):
    parsed = bind.table(spark, sf, "events").select(
        "event_id", readers.parse_literal("props", "k BIGINT").alias("countryInfo"), "event_type")
    return clean.flatten_struct(parsed, "countryInfo", "country_")


@query(f"""WITH {SNAPSHOT} SELECT country, 'country' AS region_type, country AS region_name,
  CAST(NULL AS VARCHAR) AS no_tag FROM snapshot""")
def region_tags(spark, sf):
    return clean.with_region(bind.snapshot(spark, sf).select("country"), "countries").withColumn(
        "no_tag", F.lit(None).cast("string"))


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Machines' WHEN 'FURNITURE' THEN 'Home'
  WHEN 'HOUSEHOLD' THEN 'Home' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def map_values(spark, sf):
    return clean.map_values(
        bind.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment",
        {"MACHINERY": "Machines", "FURNITURE": "Home", "HOUSEHOLD": "Home"})


@query("""SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS place FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey""")
def map_values_table(spark, sf):
    names = bind.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("old"), "n_name")
    rows = bind.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("place"))
    return clean.map_values(rows, "place", names)


@query("""SELECT o_orderkey, array_to_string(list_transform(
    regexp_extract_all(lower(trim(o_orderpriority || ' o''er-' || o_orderstatus)), '([a-z]+|[^a-z]+)'),
    lambda x: upper(x[1]) || x[2:]), '') AS title FROM orders""")
def title_case(spark, sf):
    text = F.concat(F.lit(" "), "o_orderpriority", F.lit(" o'er-"), "o_orderstatus", F.lit(" "))
    return bind.table(spark, sf, "orders").select("o_orderkey", C.title_case(text).alias("title"))


@query("""SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Russian Federation' WHEN 'BUILDING'
  THEN 'Iran, Islamic Republic Of' WHEN 'FURNITURE' THEN 'Cote D''Ivoire' ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:])
  END AS country FROM customer""")
def standardize_places(spark, sf):
    variant = C.mapped("c_mktsegment", {"MACHINERY": "Russia", "BUILDING": "Iran", "FURNITURE": "Ivory Coast"})
    rows = bind.table(spark, sf, "customer").select("c_custkey", variant.alias("country"))
    return clean.standardize_places(rows)


@query(f"""WITH {GAPPY}, named AS (SELECT o_orderkey, CASE WHEN country = 'O' THEN 'Undefined' WHEN note = '2-HIGH'
  THEN 'n/a' ELSE country END AS country FROM gappy)
  SELECT o_orderkey, country FROM named WHERE country IS NULL OR lower(country) NOT IN ('', 'null', 'undefined', 'n/a')""")
def drop_invalid(spark, sf):
    rows = gappy(spark, sf).select("o_orderkey", F.when(F.col("country") == "O", "Undefined").when(
        F.col("note") == "2-HIGH", "n/a").otherwise(F.col("country")).alias("country"))
    return clean.drop_invalid(rows, "country")


@query("SELECT c_custkey, greatest(c_acctbal, 0) AS cases, CASE WHEN c_custkey % 4 <> 0 THEN greatest(c_nationkey - 10, 0) END AS deaths FROM customer")
def clip_lower(spark, sf):
    rows = bind.table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("cases"), F.when(
        F.col("c_custkey") % 4 != 0, F.col("c_nationkey") - 10).alias("deaths"))
    return clean.clip_lower(rows)


@query("""SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
  CAST(isodow(o_orderdate) - 1 AS INT) AS day_of_week, CAST(weekofyear(o_orderdate) AS INT) AS week_of_year FROM orders""")
def calendar(spark, sf):
    rows = bind.table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date"))
    return clean.with_calendar(rows).drop("date")


@query(f"""WITH {SNAPSHOT} SELECT country, {ts_text(NOW_S)} AS processed_at,
  (epoch_us({NOW_S}) - epoch_us(updated)) / 3600000000 AS data_freshness_hours FROM snapshot""")
def freshness(spark, sf):
    return clean.with_freshness(bind.snapshot(spark, sf), bind.SNAPSHOT_AS_OF).select(
        "country", "processed_at", "data_freshness_hours")


@query(f"""SELECT c_custkey, {ts_text(NOW_S)} AS extraction_date, 'files' AS data_source, 'countries' AS data_type
  FROM customer""")
def with_lineage(spark, sf):
    return clean.with_lineage(
        bind.table(spark, sf, "customer").select("c_custkey"), bind.SNAPSHOT_AS_OF, "files", "countries")


@query(f"""WITH {RATED}, last AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY extraction_date DESC NULLS LAST, updated DESC NULLS LAST) AS rn FROM rated) WHERE rn = 1)
  SELECT upper(country[1]) || lower(country[2:]) AS country, 'country' AS region_type, cases, deaths, recovered, active,
    greatest(population, -999999) AS population, mortality_rate, recovery_rate, active_rate, cases_per_million,
    deaths_per_million, {ts_text(NOW_S)} AS processed_at FROM last""")
def transform_countries(spark, sf):
    return transforms.transform(bind.snapshot(spark, sf), "countries", bind.SNAPSHOT_AS_OF).select(
        "country", "region_type", "cases", "deaths", "recovered", "active", "population", "mortality_rate",
        "recovery_rate", "active_rate", "cases_per_million", "deaths_per_million", "processed_at")


@query(f"""WITH {SNAPSHOT} SELECT country, cases, deaths, recovered, active, {ts_text('updated')} AS updated,
  deaths / CASE WHEN cases = 0 THEN 1 ELSE cases END AS mortality_rate,
  recovered / CASE WHEN cases = 0 THEN 1 ELSE cases END AS recovery_rate, {ts_text(NOW_S)} AS processed_at FROM snapshot""")
def simple_transform(spark, sf):
    return transforms.simple_transform(bind.snapshot(spark, sf), "countries", bind.SNAPSHOT_AS_OF).select(
        "country", "cases", "deaths", "recovered", "active", "updated", "mortality_rate", "recovery_rate",
        "processed_at")


@query(f"WITH {SNAPSHOT} SELECT country, cases, deaths FROM snapshot ORDER BY country LIMIT 3")
def sample_rows(spark, sf):
    return reports.sample_rows(bind.snapshot(spark, sf), ["country", "cases", "deaths"], 3)


@query(f"""WITH {SNAPSHOT} SELECT {ts_text('updated')} AS updated, {ts_text('extraction_date')} AS extraction_date,
  {ts_text(NOW_S)} AS processed_at, data_source FROM snapshot""")
def lineage(spark, sf):
    return reports.lineage(clean.with_freshness(bind.snapshot(spark, sf), bind.SNAPSHOT_AS_OF))


@query("""SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderstatus""")
def run_sql(spark, sf):
    return writers.run_sql(spark, "SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE o_totalprice > :least "
                           "GROUP BY o_orderstatus", {"least": 100000}, orders=bind.table(spark, sf, "orders"))


# --- nested sources ---------------------------------------------------------------


def timelines(spark, sf) -> DataFrame:
    """Events of each user as a payload document: timeline struct of date -> count maps.

    The daily counts bound every map by the days of the span.
    """
    days = bind.history(spark, sf)
    entry = F.struct(F.date_format("date", "M/d/yy").alias("key"), F.col("value").alias("value"))
    pick = lambda m: F.map_from_entries(F.collect_list(F.when(F.col("metric") == m, entry)))
    return days.groupBy("country").agg(*[pick(m).alias(m) for m in ("cases", "deaths", "recovered")]).select(
        "country", F.struct("cases", "deaths", "recovered").alias("timeline"))


@query(f"""WITH {HISTORY} SELECT CAST(date AS VARCHAR) AS date, metric, value, country FROM history
  WHERE metric IN ('cases', 'deaths', 'recovered')""")
def country_history_long(spark, sf):
    return readers.country_history_long(timelines(spark, sf))


@query(f"""WITH {GLOBAL_HISTORY} SELECT CAST(date AS VARCHAR) AS date, metric, value, country FROM history
  WHERE metric IN ('cases', 'deaths', 'recovered')""")
def history_long(spark, sf):
    days = bind.global_history(spark, sf)
    entry = F.struct(F.date_format("date", "M/d/yy").alias("key"), F.col("value").alias("value"))
    document = days.agg(*[
        F.map_from_entries(F.collect_list(F.when(F.col("metric") == m, entry))).alias(m)
        for m in ("cases", "deaths", "recovered")])
    return readers.history_long(document)


@query(f"""WITH {HISTORY} SELECT country, CAST(date AS VARCHAR) AS date, value AS doses FROM history
  WHERE metric = 'recovered'""")
def vaccines_long(spark, sf):
    return readers.vaccines_long(timelines(spark, sf).select("country", F.col("timeline.recovered").alias("timeline")))


@query(f"""WITH {HISTORY}, newest AS (SELECT max(date) AS d FROM history WHERE metric IN ('cases', 'deaths', 'recovered'))
  SELECT CAST(date AS VARCHAR) AS date, metric, value, country FROM history
  WHERE metric IN ('cases', 'deaths', 'recovered') AND date > (SELECT d FROM newest) - INTERVAL 15 DAY""")
def country_history_days(spark, sf):
    return readers.country_history_long(timelines(spark, sf), days=15)


# --- duplicates ----------------------------------------------------------------------

_ITEM_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus")
_ITEM_SQL_ORDER = ", ".join(f"{c} DESC NULLS LAST" for c in _ITEM_ORDER)


@query(f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ITEM_SQL_ORDER}) = 1""")
def dedup_keys(spark, sf):
    return dedup.dedup_last(bind.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _ITEM_ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("SELECT DISTINCT text, lang FROM documents")
def dedup_rows(spark, sf):
    return dedup.dedup_rows(bind.table(spark, sf, "documents").select("text", "lang"))


@query(f"""WITH {HISTORY} SELECT count(*) AS documents FROM (SELECT DISTINCT country FROM history
  WHERE metric IN ('cases', 'deaths', 'recovered'))""")
def dedup_nested(spark, sf):
    documents = timelines(spark, sf)
    doubled = documents.unionByName(documents)
    some = F.size("timeline.cases") + F.size("timeline.deaths") + F.size("timeline.recovered") > 0
    return dedup.dedup_rows(doubled).filter(some).agg(F.count(F.lit(1)).alias("documents"))


@query("""SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicate_count,
  sum(n - 1) / sum(n) AS duplicate_percentage FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicate_stats(spark, sf):
    return dedup.duplicate_stats(bind.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT text, count(*) AS cnt FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return dedup.duplicate_keys(bind.table(spark, sf, "documents"), ["text"])


@query(f"""WITH old AS (SELECT *, 0 AS side FROM lineitem WHERE l_returnflag <> 'R'),
  fresh AS (SELECT *, 1 AS side FROM lineitem WHERE l_returnflag = 'R'),
  last AS (SELECT * FROM (SELECT * FROM old UNION ALL SELECT * FROM fresh)
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ITEM_SQL_ORDER}, side DESC) = 1)
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag FROM last""")
def upsert_latest(spark, sf):
    items = bind.table(spark, sf, "lineitem")
    merged = dedup.upsert_latest(
        items.filter("l_returnflag <> 'R'"), items.filter("l_returnflag = 'R'"), ["l_orderkey", "l_linenumber"], _ITEM_ORDER)
    return merged.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


@query("""SELECT CAST(CAST(CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0
      THEN date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH ELSE date_trunc('quarter', o_orderdate) END AS DATE) AS VARCHAR) AS snapshot_date,
  o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders""")
def upsert_partitions(spark, sf):
    """Pending orders change in a stored, partitioned table; some have no day, some move to another."""
    work = scratch(spark)
    ensure_checkpoint_dir(spark, f"{work}/checkpoint")
    quarter = F.date_trunc("quarter", "o_orderdate").cast("date")
    orders = bind.table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, quarter).alias("snapshot_date"), "o_orderkey", "o_orderstatus", "o_totalprice")
    path = writers.write_dataset(orders, f"{work}/orders", partition_by=("snapshot_date",))
    moved = F.when(F.col("o_orderkey") % 3 == 0, F.add_months("snapshot_date", 3)).otherwise(F.col("snapshot_date"))
    changed = orders.filter("o_orderstatus = 'P'").withColumns({"o_totalprice": -F.col("o_totalprice"), "snapshot_date": moved})
    writers.upsert_table(spark, path, changed, ["o_orderkey"], [])
    return spark.read.parquet(path).select("snapshot_date", "o_orderkey", "o_orderstatus", "o_totalprice")


def _order_batches(spark, sf) -> tuple[DataFrame, list[DataFrame]]:
    """Orders by quarter, without a seventh of them, and three batches: changed and moved, added, left without a day."""
    quarter = F.date_trunc("quarter", "o_orderdate").cast("date")
    orders = bind.table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 10 != 0, quarter).alias("snapshot_date"), "o_orderkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    moved = F.when(key % 3 == 0, F.add_months("snapshot_date", 3)).otherwise(F.col("snapshot_date"))
    changed = orders.filter((F.col("o_orderstatus") == "P") & (key % 7 != 0)).withColumns(
        {"o_totalprice": -F.col("o_totalprice"), "snapshot_date": moved})
    dayless = orders.filter(key % 11 == 0).withColumns(
        {"o_totalprice": 2 * F.col("o_totalprice"), "snapshot_date": F.lit(None).cast("date")})
    return orders.filter(key % 7 != 0), [changed, orders.filter(key % 7 == 0), dayless]


@query("""SELECT CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 10 = 0 THEN NULL
      WHEN o_orderstatus = 'P' AND o_orderkey % 7 <> 0 AND o_orderkey % 3 = 0
      THEN CAST(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH AS DATE) AS VARCHAR)
      ELSE CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) END AS snapshot_date, o_orderkey, o_orderstatus,
    CASE WHEN o_orderkey % 11 = 0 THEN 2 * o_totalprice WHEN o_orderstatus = 'P' AND o_orderkey % 7 <> 0 THEN -o_totalprice
      ELSE o_totalprice END AS o_totalprice FROM orders""")
def upsert_indexed(spark, sf):
    """Three batches, one after the other, into a stored table whose keys' days are kept beside it."""
    work = scratch(spark)
    ensure_checkpoint_dir(spark, f"{work}/checkpoint")
    stored, batches = _order_batches(spark, sf)
    path = writers.write_dataset(stored, f"{work}/orders", partition_by=("snapshot_date",))
    homes.build(spark.read.parquet(path), f"{work}/homes", ["o_orderkey"])
    for batch in batches:
        homes.upsert(spark, path, f"{work}/homes", batch, ["o_orderkey"], [])
    return spark.read.parquet(path).select("snapshot_date", "o_orderkey", "o_orderstatus", "o_totalprice")


# --- series ------------------------------------------------------------------------


@query(f"""WITH {CHANGES} SELECT country, metric, CAST(date AS VARCHAR) AS date, value, daily_change, daily_change_pct
  FROM changes""")
def daily_change(spark, sf):
    return series.with_daily_change(bind.history(spark, sf)).select(
        "country", "metric", "date", "value", "daily_change", "daily_change_pct")


@query(f"""WITH {CHANGES} SELECT country, metric, CAST(date AS VARCHAR) AS date,
  round(avg(value) OVER w, 6) AS value_7day_avg, round(avg(daily_change) OVER w, 6) AS daily_change_7day_avg
  FROM changes WINDOW w AS (PARTITION BY country, metric ORDER BY date ROWS 6 PRECEDING)""")
def rolling7(spark, sf):
    changed = series.with_daily_change(bind.history(spark, sf))
    out = series.with_rolling(series.with_rolling(changed, "value"), "daily_change")
    return rounded(out.select("country", "metric", "date", "value_7day_avg", "daily_change_7day_avg"),
                   "value_7day_avg", "daily_change_7day_avg")


def _lag_growth(k: int) -> str:
    return f"value / nullif(lag(value, {k}) OVER w, 0) - 1 AS growth_rate_{k}day"


@query(f"""WITH {GLOBAL_HISTORY} SELECT country, metric, CAST(date AS VARCHAR) AS date, {_lag_growth(1)}, {_lag_growth(7)},
  {_lag_growth(14)} FROM history WINDOW w AS (PARTITION BY country, metric ORDER BY date)""")
def growth(spark, sf):
    return series.with_growth(bind.global_history(spark, sf)).drop("value")


@query(f"""WITH {GLOBAL_HISTORY}, g AS (SELECT country, metric, date, {_lag_growth(1)} FROM history
    WINDOW w AS (PARTITION BY country, metric ORDER BY date))
  SELECT metric, CAST(date AS VARCHAR) AS date, round(CASE WHEN growth_rate_1day > 0
    THEN ln(2) / ln(1 + growth_rate_1day) ELSE 1e300 END, 6) AS doubling_time_days FROM g""")
def doubling_time(spark, sf):
    out = series.growth_rates(bind.global_history(spark, sf)).select("metric", "date", "doubling_time_days")
    finite = F.when(F.col("doubling_time_days") == float("inf"), F.lit(1e300)).otherwise(F.col("doubling_time_days"))
    return rounded(out.withColumn("doubling_time_days", finite), "doubling_time_days")


@query(f"""WITH {HISTORY}, g AS (SELECT country, metric, date, lag(date) OVER (PARTITION BY country, metric ORDER BY date)
  AS prev_date FROM history WHERE country <> 'Global')
  SELECT country, metric, CAST(date AS VARCHAR) AS date, CAST(prev_date AS VARCHAR) AS prev_date,
  CAST(datediff('day', prev_date, date) AS INT) AS gap_days FROM g WHERE datediff('day', prev_date, date) > 1""")
def date_gaps(spark, sf):
    return series.date_gaps(bind.history(spark, sf))


@query(f"""WITH {RATED} SELECT country, rank() OVER (ORDER BY cases DESC) AS cases_rank,
  rank() OVER (ORDER BY deaths DESC) AS deaths_rank, rank() OVER (ORDER BY mortality_rate DESC) AS mortality_rank FROM rated""",
       name="ranks")
def all_ranks(spark, sf):
    ensure_checkpoint_dir(spark, scratch(spark))
    return ranks.with_ranks(bind.rated_snapshot(spark, sf), list(reports.RANKS), reports.RANKS).select(
        "country", *reports.RANKS.values())


@query(f"""WITH {HISTORY} SELECT CAST(date AS VARCHAR) AS date, metric, value, country FROM history
  WHERE date > (SELECT max(date) FROM history) - INTERVAL 10 DAY""")
def last_days(spark, sf):
    return series.last_days(bind.history(spark, sf), 10)


@query("""SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS snapshot_date FROM orders
  WHERE CAST(o_orderdate AS DATE) <= DATE '2001-07-31'
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1""")
def snapshot_as_of(spark, sf):
    rows = bind.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("snapshot_date"))
    return series.snapshot_as_of(rows, "2001-08-01", yesterday=True, two_days_ago=True, key="o_custkey",
                                 order=["snapshot_date", "o_orderkey"])


ASKED_DAYS = ("1995-01-01", "1995-01-20", "1997-06-30", "1999-12-31", "2001-08-01", "2010-01-01")


@query(f"""WITH asked AS (SELECT unnest([{', '.join(f"DATE '{d}'" for d in ASKED_DAYS)}]) AS day)
  SELECT CAST(day AS VARCHAR) AS asked, o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS snapshot_date
  FROM asked JOIN orders ON CAST(o_orderdate AS DATE) <= day
  QUALIFY row_number() OVER (PARTITION BY day, o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1""")
def snapshot_as_of_intervals(spark, sf):
    """Newest order of each customer as of the first, some middle, the last and a later day, from three appends, one of them late."""
    work = scratch(spark)
    ensure_checkpoint_dir(spark, f"{work}/checkpoint")
    rows = bind.table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("snapshot_date"))
    late, early = F.col("o_orderkey") % 10 == 3, F.year("snapshot_date") < 2000
    for part in (early & ~late, ~early & ~late, late):
        intervals.append(spark, rows.filter(part), f"{work}/orders", "o_custkey", ["o_orderkey"])
    return reduce(DataFrame.unionByName, [
        intervals.snapshot_as_of(spark, f"{work}/orders", d).select(F.lit(d).alias("asked"), "o_custkey", "o_orderkey", "snapshot_date")
        for d in ASKED_DAYS])


@query("""SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-31' - INTERVAL 7 DAY""")
def retention(spark, sf):
    return series.apply_retention(bind.table(spark, sf, "events"), "ts", 7, "2024-01-31").select("event_id", "user_id")


@query(f"""WITH {SNAPSHOT} SELECT country, cases FROM snapshot
  WHERE extraction_date = (SELECT max(extraction_date) FROM snapshot)""")
def latest_only(spark, sf):
    return series.latest_only(bind.snapshot(spark, sf)).select("country", "cases")


# --- quality checks ------------------------------------------------------------------


def _check_sql(body: str, table: str, name: str, allowed: int, source: str = "n") -> str:
    return (f"WITH {body}, found AS ({source}) SELECT '{table}' AS table_name, '{name}' AS check_type, "
            f"count(*) AS count, CASE WHEN count(*) > {allowed} THEN 'FAIL' ELSE 'PASS' END AS status FROM found")


@query(_check_sql("rows AS (SELECT * FROM lineitem)", "lineitem", "duplicate_lines", 0,
                  "SELECT l_orderkey FROM rows GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"))
def q_duplicate_countries(spark, sf):
    return checks.q_duplicate_countries(
        bind.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "lineitem", "duplicate_lines")


@query(_check_sql(GAPPY, "gappy", "null_country_names", 0, "SELECT * FROM gappy WHERE country IS NULL OR country = ''"))
def q_null_country_names(spark, sf):
    return checks.row_checks(gappy(spark, sf).withColumns({
        c: F.lit(0) for c in ("recovered", "active", "mortality_rate")}).withColumn(
        "updated", F.lit(bind.SNAPSHOT_AS_OF).cast("timestamp")),
        checks.row_check_tests(bind.SNAPSHOT_AS_OF), "gappy", only=("null_country_names",))


@query(_check_sql("rows AS (SELECT * FROM customer)", "customer", "negative_cases", 0,
                  "SELECT * FROM rows WHERE c_acctbal < 0 OR c_nationkey - 2 < 0"))
def q_negative_cases(spark, sf):
    rows = bind.table(spark, sf, "customer").select(
        F.col("c_name").alias("country"), F.col("c_acctbal").alias("cases"),
        (F.col("c_nationkey") - 2).alias("deaths"), F.lit(0).alias("recovered"))
    return checks.q_negative_cases(rows, bind.SNAPSHOT_AS_OF, "customer")


@query(_check_sql(SNAPSHOT, "countries", "data_freshness", 0,
                  f"SELECT * FROM snapshot WHERE updated < {NOW_S} - INTERVAL 48 HOUR"))
def q_data_freshness(spark, sf):
    return checks.q_data_freshness(bind.rated_snapshot(spark, sf), bind.SNAPSHOT_AS_OF)


@query(_check_sql(SNAPSHOT, "countries", "cases_consistency", 0,
                  "SELECT * FROM snapshot WHERE tests < deaths + recovered AND tests > 0"))
def q_cases_consistency(spark, sf):
    shifted = bind.rated_snapshot(spark, sf).withColumn("cases", F.col("tests"))
    return checks.q_cases_consistency(shifted, bind.SNAPSHOT_AS_OF)


@query(_check_sql(RATED, "countries", "mortality_rate_check", 100,
                  "SELECT * FROM rated WHERE mortality_rate > 0.20 AND cases > 10"))
def q_mortality_rate(spark, sf):
    return checks.q_mortality_rate(bind.rated_snapshot(spark, sf), bind.SNAPSHOT_AS_OF, mortality_min_cases=10)


@query(_check_sql(SNAPSHOT, "countries", "active_cases_calculation", 0,
                  "SELECT * FROM snapshot WHERE abs(tests - (cases - deaths - recovered)) > cases * 0.01 AND cases > 10"))
def q_active_calculation(spark, sf):
    shifted = bind.rated_snapshot(spark, sf).withColumn("active", F.col("tests"))
    return checks.q_active_calculation(shifted, bind.SNAPSHOT_AS_OF, active_min_cases=10)


@query(_check_sql(HISTORY, "historical", "date_gaps", 100, """SELECT * FROM (SELECT date, lag(date) OVER
  (PARTITION BY country, metric ORDER BY date) AS p FROM history WHERE country <> 'Global') WHERE datediff('day', p, date) > 1"""))
def q_date_gaps(spark, sf):
    return checks.q_date_gaps(bind.history(spark, sf))


@query(_check_sql(CHANGES, "historical", "large_negative_changes", 50,
                  "SELECT * FROM changes WHERE daily_change < -1 AND metric = 'cases'"))
def q_large_negative_changes(spark, sf):
    return checks.q_large_negative_changes(series.with_daily_change(bind.history(spark, sf)), limit=-1)


@query(_check_sql(f"{SNAPSHOT}, {HISTORY}", "historical", "completeness_major_countries", 5, """
  SELECT h.country FROM history h JOIN (SELECT DISTINCT country FROM snapshot WHERE cases > 5) s ON h.country = s.country
  WHERE h.metric = 'cases' GROUP BY h.country
  HAVING count(DISTINCT h.date) / (datediff('day', min(h.date), max(h.date)) + 1) < 0.9"""))
def q_completeness_major(spark, sf):
    return checks.q_completeness_major(bind.snapshot(spark, sf), bind.history(spark, sf), min_cases=5)


@query(_check_sql(f"{SNAPSHOT}, {HISTORY}", "cross_table_consistency", "historical_vs_current", 20, f"""
  SELECT s.country FROM snapshot s JOIN (SELECT country, max(CASE WHEN metric = 'cases' THEN value END) AS hc,
    max(CASE WHEN metric = 'deaths' THEN value END) AS hd FROM history WHERE date >= CAST({NOW_H} AS DATE) - INTERVAL 7 DAY
    GROUP BY country) h ON s.country = h.country
  WHERE s.cases > 5 AND (abs(s.cases - hc) > s.cases * 0.1 OR abs(s.deaths - hd) > s.deaths * 0.1)"""))
def q_historical_vs_current(spark, sf):
    return checks.q_historical_vs_current(
        bind.snapshot(spark, sf), bind.history(spark, sf), bind.HISTORY_AS_OF, min_cases=5)


_MINIMUM = {"customer": 190, "region": 6, "nation": 50, "supplier": 1}


@query(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS record_count, {n} AS minimum_expected, "
    f"CASE WHEN count(*) >= {n} THEN 'PASS' ELSE 'FAIL' END AS status FROM {t}" for t, n in _MINIMUM.items()))
def q_min_record_counts(spark, sf):
    return checks.q_min_record_counts({t: bind.table(spark, sf, t) for t in _MINIMUM}, _MINIMUM)


@query(f"""WITH {SNAPSHOT}, latest AS (
    SELECT 'countries' AS table_name, max(extraction_date) AS latest_extraction FROM snapshot
    UNION ALL SELECT 'events', max(ts) FROM events)
  SELECT table_name, {ts_text('latest_extraction')} AS latest_extraction,
    round((epoch_us({NOW_S}) - epoch_us(latest_extraction)) / 3600000000, 6) AS hours_since_extraction,
    CASE WHEN (epoch_us({NOW_S}) - epoch_us(latest_extraction)) / 3600000000 <= 24 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM latest""")
def q_recent_data(spark, sf):
    events = bind.table(spark, sf, "events").select(F.col("ts").alias("extraction_date"))
    tables = {"countries": bind.snapshot(spark, sf), "events": events}
    return rounded(checks.q_recent_data(tables, bind.SNAPSHOT_AS_OF), "hours_since_extraction")


_SUMMARY_CHECKS = f"""WITH {RATED}, results AS (
  SELECT (SELECT count(*) FROM (SELECT country FROM snapshot GROUP BY country, extraction_date HAVING count(*) > 1)) > 0 AS failed
  UNION ALL SELECT count(*) FILTER (country IS NULL OR country = '') > 0 FROM snapshot
  UNION ALL SELECT count(*) FILTER (cases < 0 OR deaths < 0 OR recovered < 0) > 0 FROM snapshot
  UNION ALL SELECT count(*) FILTER (updated < {NOW_S} - INTERVAL 48 HOUR) > 0 FROM snapshot
  UNION ALL SELECT count(*) FILTER (cases < deaths + recovered AND cases > 0) > 0 FROM snapshot
  UNION ALL SELECT count(*) FILTER (mortality_rate > 0.2 AND cases > 10) > 100 FROM rated
  UNION ALL SELECT count(*) FILTER (abs(active - (cases - deaths - recovered)) > cases * 0.01 AND cases > 10) > 0 FROM snapshot
  UNION ALL SELECT count(*) < 190 FROM snapshot)"""


@query(_SUMMARY_CHECKS + """, t AS (SELECT count(*) AS total_checks, count(*) FILTER (NOT failed) AS passed_checks,
    count(*) FILTER (failed) AS failed_checks FROM results)
  SELECT total_checks, passed_checks, failed_checks, round(passed_checks * 100.0 / total_checks, 2) AS pass_percentage,
    CASE WHEN failed_checks = 0 THEN 'EXCELLENT' WHEN failed_checks <= 2 THEN 'GOOD' WHEN failed_checks <= 5 THEN 'FAIR'
    ELSE 'POOR' END AS overall_quality FROM t""")
def q_summary(spark, sf):
    return checks.q_summary(checks.all_checks(
        bind.rated_snapshot(spark, sf), None, bind.SNAPSHOT_AS_OF, mortality_min_cases=10, active_min_cases=10))


# --- completeness checks ----------------------------------------------------------------


def _completeness_sql(body: str, category: str, name: str, allowed: int, source: str) -> str:
    return (f"WITH {body}, found AS ({source}) SELECT '{category}' AS check_category, '{name}' AS check_name, "
            f"count(*) AS count, CASE WHEN count(*) > {allowed} THEN 'FAIL' ELSE 'PASS' END AS status FROM found")


_DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"
_MISSING_DAYS = """SELECT CAST(d AS DATE) AS expected_date FROM (SELECT unnest(generate_series(
  (SELECT min(day) FROM days), (SELECT max(day) FROM days), INTERVAL 1 DAY)) AS d)
  WHERE CAST(d AS DATE) NOT IN (SELECT day FROM days)"""


@query(_completeness_sql(_DAYS, "temporal_completeness", "missing_dates_historical", 7, _MISSING_DAYS))
def m_missing_dates(spark, sf):
    return completeness.m_missing_dates(bind.table(spark, sf, "orders"), "o_orderdate")


@query(f"WITH {_DAYS}, m AS ({_MISSING_DAYS}) SELECT CAST(expected_date AS VARCHAR) AS expected_date FROM m")
def missing_dates(spark, sf):
    return completeness.missing_dates(bind.table(spark, sf, "orders"), "o_orderdate")


@query(_completeness_sql(f"{SNAPSHOT}, {HISTORY}", "temporal_completeness", "countries_missing_recent_data", 10, f"""
  SELECT DISTINCT country FROM snapshot WHERE cases > 10 AND country NOT IN (SELECT country FROM history
  WHERE date >= CAST({NOW_H} AS DATE) - INTERVAL 7 DAY)"""))
def m_missing_recent(spark, sf):
    return completeness.m_missing_recent(
        bind.snapshot(spark, sf), bind.history(spark, sf), bind.HISTORY_AS_OF, min_cases=10)


_EXPECTED_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "OCEANIA")


@query(_completeness_sql(SNAPSHOT, "geographical_completeness", "missing_continents", 0, f"""
  SELECT e FROM (VALUES {', '.join(f"('{e}')" for e in _EXPECTED_REGIONS)}) AS t(e)
  WHERE e NOT IN (SELECT continent FROM snapshot)"""))
def m_missing_continents(spark, sf):
    return completeness.m_missing_continents(bind.snapshot(spark, sf), _EXPECTED_REGIONS)


_EXPECTED_CUSTOMERS = tuple(f"Customer#{i:09d}" for i in (0, 1, 2, 3, 5, 8, 13, 21, 34, 55, 999_999_999))


@query(_completeness_sql(SNAPSHOT, "geographical_completeness", "missing_major_countries", 2, f"""
  SELECT e FROM (VALUES {', '.join(f"('{e}')" for e in _EXPECTED_CUSTOMERS)}) AS t(e)
  WHERE e NOT IN (SELECT country FROM snapshot)"""))
def m_missing_countries(spark, sf):
    return completeness.m_missing_countries(bind.snapshot(spark, sf), _EXPECTED_CUSTOMERS)


_EXPECTED_NATIONS = ("NATION_0", "NATION_7", "NATION_24", "NATION_25", "NATION_30", "NATION_31", "NATION_32")


@query(_completeness_sql("t AS (SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey)",
                         "geographical_completeness", "missing_major_states", 3, f"""
  SELECT e FROM (VALUES {', '.join(f"('{e}')" for e in _EXPECTED_NATIONS)}) AS x(e) WHERE e NOT IN (SELECT n_name FROM t)"""))
def m_missing_states(spark, sf):
    states = bind.table(spark, sf, "supplier").join(
        bind.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("state"))
    return completeness.m_missing_states(states, _EXPECTED_NATIONS)


_METRIC_GAPS = GAPPY + ", metrics AS (SELECT cases, deaths, CASE WHEN o_orderkey % 11 = 0 THEN 0 WHEN o_orderkey % 13 = 0 THEN NULL ELSE 5 END AS population FROM gappy)"


def _metric_rows(spark, sf) -> DataFrame:
    key = F.col("o_orderkey")
    return gappy(spark, sf).select("cases", "deaths", F.when(key % 11 == 0, 0).when(key % 13 != 0, 5).alias("population"))


for _name, _allowed, _test in (
        ("countries_missing_cases", 5, "cases IS NULL"),
        ("countries_missing_deaths", 10, "deaths IS NULL AND cases > 3"),
        ("countries_missing_population", 20, "population IS NULL OR population = 0")):
    query(_completeness_sql(_METRIC_GAPS, "metric_completeness", _name, _allowed, f"SELECT * FROM metrics WHERE {_test}"),
          name="m_" + _name.removeprefix("countries_"))(
        lambda spark, sf, name=_name: completeness.metric_checks(_metric_rows(spark, sf), only=(name,), deaths_min_cases=3))


@query(_completeness_sql(HISTORY, "metric_completeness", "historical_metrics_incomplete", 50, f"""
  SELECT country FROM history WHERE country <> 'Global' AND date >= CAST({NOW_H} AS DATE) - INTERVAL 30 DAY GROUP BY country
  HAVING count(DISTINCT CASE WHEN metric = 'cases' THEN date END) < 0.8 * count(DISTINCT date)
      OR count(DISTINCT CASE WHEN metric = 'deaths' THEN date END) < 0.8 * count(DISTINCT date)"""))
def m_metric_days(spark, sf):
    return completeness.m_metric_days(bind.history(spark, sf), bind.HISTORY_AS_OF)


@query(f"""WITH {HISTORY} SELECT country, count(DISTINCT CASE WHEN metric = 'cases' THEN date END) AS cases_days,
  count(DISTINCT CASE WHEN metric = 'deaths' THEN date END) AS deaths_days,
  count(DISTINCT CASE WHEN metric = 'recovered' THEN date END) AS recovered_days, count(DISTINCT date) AS total_days
  FROM history WHERE date >= CAST({NOW_H} AS DATE) - INTERVAL 30 DAY GROUP BY country""")
def metric_day_counts(spark, sf):
    return completeness.metric_day_counts(bind.history(spark, sf), bind.HISTORY_AS_OF)


@query(f"""WITH {SNAPSHOT} SELECT 'coverage_analysis' AS check_category, 'continent_coverage' AS check_name, continent,
  count(*) AS countries_count, count(*) FILTER (tests > 1) AS countries_with_cases,
  round(count(*) FILTER (tests > 1) * 100.0 / count(*), 2) AS coverage_percentage,
  CASE WHEN count(*) FILTER (tests > 1) * 100.0 / count(*) >= 80 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM snapshot WHERE continent IS NOT NULL AND continent <> '' GROUP BY continent""")
def m_group_coverage(spark, sf):
    return completeness.m_group_coverage(bind.snapshot(spark, sf).withColumn("cases", F.col("tests") - 1))


@query(f"""WITH {SNAPSHOT}, rows AS (SELECT data_source, data_type, extraction_date FROM snapshot
    UNION ALL SELECT event_type, 'events', ts FROM events)
  SELECT 'coverage_analysis' AS check_category, 'data_recency' AS check_name, data_source, data_type,
    {ts_text('max(extraction_date)')} AS latest_extraction, count(*) AS record_count,
    round((epoch_us({NOW_H}) - epoch_us(max(extraction_date))) / 3600000000, 6) AS hours_old,
    CASE WHEN (epoch_us({NOW_H}) - epoch_us(max(extraction_date))) / 3600000000 <= 24 THEN 'PASS' ELSE 'FAIL' END AS status
  FROM rows GROUP BY data_source, data_type""")
def m_recency(spark, sf):
    events = bind.table(spark, sf, "events").select(
        F.col("event_type").alias("data_source"), F.lit("events").alias("data_type"), F.col("ts").alias("extraction_date"))
    return rounded(completeness.m_recency([bind.snapshot(spark, sf), events], bind.HISTORY_AS_OF), "hours_old")


@query(f"""WITH {SNAPSHOT}, {HISTORY}, m AS (
    SELECT 'countries' AS data_type, count(*) AS total_records, count(*) FILTER (country <> '') AS a, count(cases) AS b,
      count(deaths) AS c, count(*) FILTER (population > 0) AS d FROM snapshot
    UNION ALL SELECT 'historical', count(*), count(*), count(value), count(*), count(*) FROM history
      WHERE date >= CAST({NOW_H} AS DATE) - INTERVAL 7 DAY),
  s AS (SELECT data_type, total_records, round(a * 100.0 / total_records, 2) AS country_completeness,
    round(b * 100.0 / total_records, 2) AS cases_completeness, round(c * 100.0 / total_records, 2) AS deaths_completeness,
    round(d * 100.0 / total_records, 2) AS population_completeness FROM m),
  g AS (SELECT *, (country_completeness + cases_completeness + deaths_completeness + population_completeness) / 4 AS mean FROM s)
  SELECT 'completeness_scoring' AS check_category, 'overall_completeness' AS check_name, data_type, total_records,
    country_completeness, cases_completeness, deaths_completeness, population_completeness,
    round(mean, 2) AS avg_completeness, CASE WHEN mean >= 95 THEN 'EXCELLENT' WHEN mean >= 90 THEN 'GOOD'
    WHEN mean >= 80 THEN 'FAIR' ELSE 'POOR' END AS completeness_grade FROM g""")
def m_scores(spark, sf):
    return completeness.m_scores(bind.snapshot(spark, sf), bind.history(spark, sf), bind.HISTORY_AS_OF)


@query(f"""WITH {SNAPSHOT}, {HISTORY}, t AS (
    SELECT count(DISTINCT country) AS n, count(DISTINCT continent) AS c, count(*) AS r, max(extraction_date) AS l FROM snapshot
    UNION ALL SELECT count(DISTINCT country), 0, count(*), max(CAST(date AS TIMESTAMP)) FROM history
      WHERE date >= CAST({NOW_H} AS DATE) - INTERVAL 30 DAY)
  SELECT 'completeness_summary' AS report_type, {ts_text(NOW_H)} AS report_timestamp,
    'Data completeness validation completed' AS status, max(n) AS total_countries, max(c) AS total_continents,
    {ts_text('max(l)')} AS latest_data, (epoch_us({NOW_H}) - epoch_us(max(l))) / 3600000000 AS data_age_hours,
    CAST(sum(r) AS BIGINT) AS total_records FROM t""")
def m_summary(spark, sf):
    history = bind.history(spark, sf).withColumn("extraction_date", F.col("date").cast("timestamp_ntz"))
    out = completeness.m_summary(bind.snapshot(spark, sf), history, bind.HISTORY_AS_OF)
    parsed = F.from_json("summary_metrics", "total_countries BIGINT, total_continents BIGINT, latest_data STRING, "
                         "data_age_hours DOUBLE, total_records BIGINT")
    return out.withColumn("p", parsed).select("report_type", "report_timestamp", "status", "p.*")


# --- validation ---------------------------------------------------------------------


@query(f"""WITH {GAPPY}, n AS (SELECT count(*) AS n, {', '.join(f'count(*) - count({c}) AS {c}' for c in ('o_orderkey', 'cases', 'deaths', 'price_rate', 'country', 'note'))} FROM gappy),
  u AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS null_count, n FROM n" for c in ('o_orderkey', 'cases', 'deaths', 'price_rate', 'country', 'note'))})
  SELECT column_name, null_count, null_count / n AS null_percentage, null_count / n > 0.1 AS is_high FROM u""")
def null_profile(spark, sf):
    return quality.null_profile(gappy(spark, sf))


def _iqr_sql(table: str, columns) -> str:
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} < lo OR {c} > hi) AS outlier_count,
          count(*) FILTER ({c} < lo OR {c} > hi) / count(*) AS outlier_percentage, round(any_value(lo), 6) AS lower_bound,
          round(any_value(hi), 6) AS upper_bound FROM {table}, (SELECT quantile_cont({c}, 0.25) - 1.5 *
          (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lo, quantile_cont({c}, 0.75) + 1.5 *
          (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS hi FROM {table})""")
    return " UNION ALL ".join(parts)


@query(_iqr_sql("lineitem", ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def iqr_outliers(spark, sf):
    out = quality.iqr_outliers(
        bind.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return rounded(out, "lower_bound", "upper_bound")


@query(_iqr_sql("events", ("value",)))
def iqr_outliers_events(spark, sf):
    return rounded(quality.iqr_outliers(bind.table(spark, sf, "events"), ["value"]), "lower_bound", "upper_bound")


@query("SELECT 'value' AS column_name, " + ", ".join(
    f"round(quantile_cont(value, {p}), 6) AS q{int(p * 100)}" for p in (0.25, 0.5, 0.75)) + " FROM events")
def quartiles(spark, sf):
    q = quantiles.quantiles(bind.table(spark, sf, "events"), ["value"], (0.25, 0.5, 0.75))["value"]
    return rounded(spark.createDataFrame([("value", *q)], "column_name STRING, q25 DOUBLE, q50 DOUBLE, q75 DOUBLE"),
                   "q25", "q50", "q75")


def observations(spark, sf) -> DataFrame:
    """Events as raw series rows, repeated points included."""
    return bind.table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("date"), C.mapped("event_type", bind.EVENT_METRICS).alias("metric"),
        F.round("value").cast("bigint").alias("value"), F.col("user_id").cast("string").alias("country"))


_OBSERVED = f"""
observed AS (SELECT CAST(ts AS DATE) AS date, {_METRIC} AS metric, CAST(round(value) AS BIGINT) AS value,
  CAST(user_id AS VARCHAR) AS country FROM events),
facts AS (SELECT (SELECT count(*) FROM observed) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM observed)) AS u,
  (SELECT count(*) FROM observed WHERE metric NOT IN ('cases', 'deaths', 'recovered')) AS unknown,
  (SELECT min(date) FROM observed) AS lo, (SELECT max(date) FROM observed) AS hi)"""


@query(f"""WITH {_OBSERVED}, w AS (SELECT *, CAST(n < 100 AS INT) + CAST(n > u AS INT) + CAST(unknown > 0 AS INT)
    + CAST(lo < DATE '2019-12-01' AS INT) + CAST(hi > {NOW_H} + INTERVAL 1 DAY AS INT) AS warnings, (n - u) / n AS dup FROM facts)
  SELECT 'historical' AS dataset, n AS record_count, 4 AS column_count, true AS is_valid, 0 AS error_count,
    warnings AS warning_count, round(dup, 9) AS duplicate_percentage,
    round(greatest(0, 100 - 5 * warnings - CASE WHEN dup > 0.05 THEN dup * 30 ELSE 0 END), 6) AS quality_score FROM w""")
def validate(spark, sf):
    out = quality.validate(observations(spark, sf), "historical", bind.HISTORY_AS_OF)
    return rounded(out.select("dataset", "record_count", "column_count", "is_valid", F.size("errors").alias("error_count"),
                              F.size("warnings").alias("warning_count"),
                              F.round("duplicate_percentage", 9).alias("duplicate_percentage"), "quality_score"), "quality_score")


@query(f"""WITH {_OBSERVED} SELECT 'historical' AS dataset, x.check_name, x.severity, CAST(x.observed AS DOUBLE) AS observed,
    CASE WHEN x.bad THEN 'FAIL' ELSE 'PASS' END AS status
  FROM facts, LATERAL (VALUES ('empty', 'error', n, n = 0), ('min_rows', 'warning', n, n > 0 AND n < 100),
    ('duplicate_rows', 'warning', n - u, n > u), ('null_share', 'warning', 0, false), ('required_columns', 'error', 0, false),
    ('bad_date', 'error', 0, false), ('unknown_metric', 'warning', unknown, unknown > 0),
    ('first_date', 'warning', datediff('day', DATE '1970-01-01', lo), lo < DATE '2019-12-01'),
    ('last_date', 'warning', datediff('day', DATE '1970-01-01', hi), hi > {NOW_H} + INTERVAL 1 DAY))
    AS x(check_name, severity, observed, bad)""")
def check_results(spark, sf):
    return quality.check_results(observations(spark, sf), "historical", bind.HISTORY_AS_OF).select(
        "dataset", "check_name", "severity", "observed", "status")


@query(f"""WITH {GAPPY}, facts AS (SELECT (SELECT count(*) FROM gappy) AS n, (SELECT count(DISTINCT country) FROM gappy) AS d,
    (SELECT count(*) FROM gappy WHERE country IS NULL) AS missing, (SELECT count(*) FROM gappy WHERE cases IS NULL) AS c,
    (SELECT count(*) FROM gappy WHERE deaths IS NULL) AS e)
  SELECT CASE WHEN missing > 0 THEN false ELSE true END AS is_valid,
    n - d - CAST(missing > 0 AS INT) AS duplicate_countries, missing AS null_countries, round(greatest(0, 100
    - 20 * CAST(missing > 0 AS INT) - 5 * (CAST(n < 100 AS INT) + CAST(n - d - CAST(missing > 0 AS INT) > 0 AS INT)
      + CAST(greatest(missing, c, e) / n > 0.1 AS INT) + 1)
    - 50 * (greatest(missing / n - 0.1, 0) + greatest(c / n - 0.1, 0) + greatest(e / n - 0.1, 0))
    - 30 * (SELECT 1 - count(*) / (SELECT n FROM facts) FROM (SELECT DISTINCT country, cases, deaths FROM gappy))), 6) AS quality_score
  FROM facts""")
def validate_countries(spark, sf):
    rows = gappy(spark, sf).select("country", "cases", "deaths")
    results = quality.check_results(rows, "countries", bind.SNAPSHOT_AS_OF)
    seen = lambda name: F.max(F.when(F.col("check_name") == name, F.col("observed"))).cast("bigint")
    score = quality.validate(rows, "countries", bind.SNAPSHOT_AS_OF).select("quality_score").scalar()
    failed = F.count_if((F.col("severity") == "error") & (F.col("status") == "FAIL"))
    return results.agg((failed == 0).alias("is_valid"), seen("duplicate_countries").alias("duplicate_countries"),
                       seen("null_country").alias("null_countries")).withColumn("quality_score", F.round(score, 6))


@query(f"""WITH {SNAPSHOT} SELECT 'cases_below_outcomes' AS rule, count(*) FILTER (tests < deaths + recovered) AS violations FROM snapshot
  UNION ALL SELECT 'active_mismatch', count(*) FILTER (abs(active - (tests - deaths - recovered)) > tests * 0.01) FROM snapshot
  UNION ALL SELECT 'high_death_rate', count(*) FILTER (CASE WHEN tests = 0 THEN deaths > 0 ELSE deaths / tests > 0.1 END) FROM snapshot""")
def rules(spark, sf):
    return quality.rule_violations(bind.snapshot(spark, sf).withColumn("cases", F.col("tests")), "countries")


def _bundle(spark, sf) -> dict[str, DataFrame]:
    return {"gappy": gappy(spark, sf), "region": bind.table(spark, sf, "region"), "nation": bind.table(spark, sf, "nation")}


@query(f"""WITH {GAPPY}, q AS (
    SELECT 'gappy' AS dataset, count(*) AS record_count, 6 AS column_count,
      6 * count(*) - count(o_orderkey) - count(cases) - count(deaths) - count(price_rate) - count(country) - count(note) AS missing_values FROM gappy
    UNION ALL SELECT 'region', count(*), 2, 0 FROM region UNION ALL SELECT 'nation', count(*), 3, 0 FROM nation),
  a AS (SELECT dataset, record_count, column_count, missing_values, record_count * column_count AS cells FROM q
    UNION ALL SELECT 'TOTAL', CAST(sum(record_count) AS BIGINT), NULL, CAST(sum(missing_values) AS BIGINT), sum(record_count * column_count) FROM q),
  p AS (SELECT *, (1 - missing_values / cells) * 100 AS pc FROM a)
  SELECT dataset, record_count, column_count, missing_values, round(pc, 6) AS completeness,
    CASE WHEN pc > 95 THEN 'Excellent' WHEN pc > 90 THEN 'Good' ELSE 'Poor' END AS grade FROM p""")
def completeness_grade(spark, sf):
    return rounded(quality.completeness_grade(_bundle(spark, sf)), "completeness")


@query("""SELECT 'region' AS dataset, count(*) AS record_count, 2 AS column_count, count(*) = 0 AS is_empty,
    CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count(*) < 10 THEN 'FEW' ELSE 'OK' END AS gate FROM region
  UNION ALL SELECT 'nation', count(*), 3, count(*) = 0, CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count(*) < 10 THEN 'FEW' ELSE 'OK' END FROM nation
  UNION ALL SELECT 'orders', count(*), 6, count(*) = 0, CASE WHEN count(*) = 0 THEN 'EMPTY' WHEN count(*) < 10 THEN 'FEW' ELSE 'OK' END FROM orders""")
def bundle_summary(spark, sf):
    summary = quality.bundle_summary({t: bind.table(spark, sf, t) for t in ("region", "nation", "orders")})
    gate = quality.gate_extraction(summary).select("dataset", "gate")
    return summary.select("dataset", "record_count", "column_count", "is_empty").join(gate, "dataset")


@query(f"""WITH {RATED} SELECT 'snapshot' AS dataset, count(*) AS record_count, 17 AS column_count,
    count(*) - count(updated) + count(*) - count(extraction_date) AS missing_values, true AS has_extraction_date,
    false AS has_processed_at, true AS has_mortality_rate FROM rated""")
def file_quality(spark, sf):
    return quality.file_quality({"snapshot": bind.rated_snapshot(spark, sf)})


@query(f"""WITH {_OBSERVED}, v AS (SELECT 'history' AS dataset, n, 4 AS k FROM facts UNION ALL SELECT 'nation', count(*), 3 FROM nation)
  SELECT 'total' AS level, CAST(NULL AS VARCHAR) AS dataset, CAST(sum(n) AS BIGINT) AS record_count, CAST(NULL AS INT) AS column_count,
    count(*) AS valid_datasets, CAST(0 AS BIGINT) AS invalid_datasets FROM v
  UNION ALL SELECT 'dataset', dataset, n, k, 1, 0 FROM v""")
def validation_report(spark, sf):
    results = quality.validate(observations(spark, sf), "historical", bind.HISTORY_AS_OF).withColumn(
        "dataset", F.lit("history")).unionByName(
        quality.validate(bind.table(spark, sf, "nation"), "nation", bind.HISTORY_AS_OF))
    return quality.validation_report(results).select(
        "level", "dataset", "record_count", "column_count", "valid_datasets", "invalid_datasets")


_ITEM_TYPES = {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
               "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
               "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"}
_ITEM_NUMBERS = tuple(c for c, t in _ITEM_TYPES.items() if t in ("bigint", "int", "double"))


@query("WITH o AS (" + _iqr_sql("lineitem", _ITEM_NUMBERS) + "), n AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, 1 - count({c}) / count(*) AS null_percentage,
    1 - count({c}) / count(*) > 0.1 AS is_high, '{t}' AS data_type FROM lineitem""" for c, t in _ITEM_TYPES.items())
    + ") SELECT n.*, outlier_count, outlier_percentage, lower_bound, upper_bound FROM n LEFT JOIN o USING (column_name)")
def profile(spark, sf):
    return rounded(quality.profile(bind.table(spark, sf, "lineitem")), "lower_bound", "upper_bound")


# --- reports ----------------------------------------------------------------------------


@query(f"""WITH {RATED} SELECT {', '.join(c for c in reports.LATEST_COLUMNS if c not in ('updated', 'extraction_date'))},
  {ts_text('updated')} AS updated, {ts_text('extraction_date')} AS extraction_date FROM rated
  WHERE extraction_date = (SELECT max(extraction_date) FROM rated)""")
def latest_stats(spark, sf):
    return reports.latest_stats(bind.rated_snapshot(spark, sf))


@query(f"""WITH {CHANGES.replace(HISTORY, GLOBAL_HISTORY)} SELECT CAST(date AS VARCHAR) AS date,
  CAST(sum(CASE WHEN metric = 'cases' THEN value END) AS BIGINT) AS total_cases,
  CAST(sum(CASE WHEN metric = 'deaths' THEN value END) AS BIGINT) AS total_deaths,
  CAST(sum(CASE WHEN metric = 'recovered' THEN value END) AS BIGINT) AS total_recovered,
  avg(CASE WHEN metric = 'cases' THEN daily_change END) AS avg_daily_cases,
  avg(CASE WHEN metric = 'deaths' THEN daily_change END) AS avg_daily_deaths FROM changes WHERE country = 'Global' GROUP BY date""")
def global_trends(spark, sf):
    return reports.global_trends(series.with_daily_change(bind.global_history(spark, sf)))


@query(f"""WITH {RATED}, latest AS (SELECT * FROM rated WHERE extraction_date = (SELECT max(extraction_date) FROM rated))
  SELECT {', '.join(reports.RANKED_COLUMNS)}, rank() OVER (ORDER BY cases DESC) AS cases_rank,
  rank() OVER (ORDER BY deaths DESC) AS deaths_rank, rank() OVER (ORDER BY mortality_rate DESC) AS mortality_rank
  FROM latest WHERE cases > 5 ORDER BY cases DESC, country LIMIT 50""")
def top_affected(spark, sf):
    return reports.top_affected(bind.rated_snapshot(spark, sf), 50, min_cases=5)


@query(f"""WITH {RATED} SELECT country, cases, deaths, mortality_rate, coalesce(mortality_rate, 0) * 100 AS mortality_pct
  FROM rated ORDER BY cases DESC, country LIMIT 10""")
def top_n(spark, sf):
    return reports.top_n(bind.rated_snapshot(spark, sf), "country", 10)


@query(f"""WITH {RATED} SELECT country, cases, deaths, mortality_rate, coalesce(mortality_rate, 0) * 100 AS mortality_pct
  FROM rated WHERE cases > 10 ORDER BY mortality_rate DESC, country LIMIT 15""")
def top_mortality(spark, sf):
    return reports.top_mortality(bind.rated_snapshot(spark, sf), "country", 15, min_cases=10)


@query(f"""WITH {SNAPSHOT}, c AS (SELECT continent, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths,
  CAST(sum(recovered) AS BIGINT) AS recovered FROM snapshot GROUP BY continent)
  SELECT continent, cases, deaths, deaths / cases * 100 AS mortality_pct FROM c""")
def ranked_continents(spark, sf):
    sums = reports.rollup_by(bind.snapshot(spark, sf))
    return reports.ranked_by(clean.with_rates(sums, "continents"), "continent")


@query(f"""WITH {SNAPSHOT} SELECT continent, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths,
  CAST(sum(recovered) AS BIGINT) AS recovered, CAST(sum(population) AS BIGINT) AS population FROM snapshot GROUP BY continent""")
def rollup_by(spark, sf):
    return reports.rollup_by(bind.snapshot(spark, sf), "continent", ("cases", "deaths", "recovered", "population"))


@query(f"""WITH {SNAPSHOT} SELECT continent, CAST(sum(cases) AS BIGINT) AS cases,
  sum(cases) * 100.0 / (SELECT sum(cases) FROM snapshot) AS share_pct FROM snapshot GROUP BY continent""")
def share_of_total(spark, sf):
    return reports.share_of_total(bind.snapshot(spark, sf))


@query(f"""WITH {RATED} SELECT count(*) AS regions, CAST(sum(cases) AS BIGINT) AS total_cases,
  CAST(sum(deaths) AS BIGINT) AS total_deaths, round(avg(mortality_rate), 6) AS avg_mortality,
  max(mortality_rate) AS max_mortality, min(mortality_rate) AS min_mortality,
  count(*) FILTER (deaths = 0) AS regions_without_deaths FROM rated""")
def summary_stats(spark, sf):
    return rounded(reports.summary_stats(bind.rated_snapshot(spark, sf)), "avg_mortality")


@query(f"""WITH {SNAPSHOT}, g AS (SELECT CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths,
    CAST(sum(recovered) AS BIGINT) AS recovered, CAST(sum(active) AS BIGINT) AS active, count(*) AS affected_countries,
    max(extraction_date) AS extraction_date, max(updated) AS updated, CAST(sum(greatest(population, 0)) AS BIGINT) AS population FROM snapshot)
  SELECT cases, deaths, recovered, active, deaths / cases AS mortality_rate, recovered / cases AS recovery_rate, affected_countries,
    cases / population * 1000000 AS cases_per_million, deaths / population * 1000000 AS deaths_per_million,
    {ts_text('updated')} AS updated FROM g""")
def global_kpis(spark, sf):
    total = bind.snapshot(spark, sf).agg(
        *[F.sum(c).alias(c) for c in ("cases", "deaths", "recovered", "active")],
        F.count(F.lit(1)).alias("affected_countries"), F.max("extraction_date").alias("extraction_date"),
        F.max("updated").alias("updated"), F.sum(F.greatest("population", F.lit(0))).alias("population"))
    return reports.global_kpis(clean.with_rates(total, "global"))


@query("SELECT 'orders' AS dataset, count(*) AS record_count FROM orders UNION ALL SELECT 'events', count(*) FROM events")
def records_per_dataset(spark, sf):
    return reports.records_per_dataset({t: bind.table(spark, sf, t) for t in ("orders", "events")})


# --- sinks, tables, incremental runs ---------------------------------------------------


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END AS is_large, coalesce(nullif(o_orderstatus, 'F'), '') AS o_orderstatus FROM orders""")
def coerce_text_sink(spark, sf):
    return writers.coerce_text_sink(bind.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", (F.col("o_totalprice") > 100000).alias("is_large"),
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus")))


@query("""SELECT event_id, '{"k":' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) || '}' AS props,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type FROM events""")
def coerce_string_sink(spark, sf):
    return writers.coerce_string_sink(bind.table(spark, sf, "events").select(
        "event_id", readers.parse_literal("props", "k BIGINT").alias("props"),
        F.when(F.col("event_type") == "error", "nan").otherwise(F.col("event_type")).alias("event_type")))


@query(f"""WITH {RATED} SELECT country, CAST(NULL AS BIGINT) AS critical, cases, tests, continent,
  CAST(CAST(mortality_rate AS DECIMAL(10, 6)) AS DOUBLE) AS mortality_rate,
  CAST(CAST(cases_per_million AS DECIMAL(10, 2)) AS DOUBLE) AS cases_per_million, 40 AS columns FROM rated""")
def conform(spark, sf):
    renamed = bind.rated_snapshot(spark, sf)
    out = writers.conform_to_warehouse(renamed, "countries")
    return out.select("country", "critical", "cases", "tests", "continent", F.col("mortality_rate").cast("double").alias("mortality_rate"),
                      F.col("cases_per_million").cast("double").alias("cases_per_million"), F.lit(len(out.columns)).alias("columns"))


@query("""SELECT o_orderstatus AS table_name, count(*) AS expected_count, count(*) FILTER (o_orderpriority <> '5-LOW' OR o_orderstatus <> 'F') AS actual_count,
  o_orderstatus <> 'F' AS count_match FROM orders GROUP BY o_orderstatus""")
def reconcile_load(spark, sf):
    orders = bind.table(spark, sf, "orders")
    expected = orders.groupBy(F.col("o_orderstatus").alias("table_name")).agg(F.count(F.lit(1)).alias("expected_count"))
    stored = orders.filter("o_orderpriority <> '5-LOW' OR o_orderstatus <> 'F'").select(F.col("o_orderstatus").alias("table_name"))
    return writers.reconcile_load(stored, expected).select("table_name", "expected_count", "actual_count", "count_match")


_ROUND_TRIP = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders"


def _round_trip(fmt: str) -> Query:
    def run(spark, sf):
        rows = bind.table(spark, sf, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        uri = writers.write_dataset(rows, f"{scratch(spark)}/orders.{fmt}", fmt, mode="overwrite")
        return readers.read_dataset(spark, uri, schema=rows.schema)
    return run


for _fmt in readers.FORMATS:
    query(_ROUND_TRIP, name=f"round_trip_{_fmt}")(_round_trip(_fmt))


@query("""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS snapshot_date, o_orderkey FROM orders
  WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY""")
def retention_partitions(spark, sf):
    rows = writers.with_snapshot_date(bind.table(spark, sf, "orders").withColumnRenamed("o_orderdate", "extraction_date"), "countries")
    uri = writers.write_dataset(
        rows.withColumn("month", F.date_format("snapshot_date", "yyyy-MM")), f"{scratch(spark)}/orders", partition_by=("month",))
    newest = rows.agg(F.max("snapshot_date")).first()[0]
    stored = readers.read_dataset(spark, uri).filter(F.col("month") >= F.date_format(F.date_sub(F.lit(newest), 90), "yyyy-MM"))
    return series.apply_retention(stored, "snapshot_date", 90, newest).select("snapshot_date", "o_orderkey")


@query(f"WITH {HISTORY} SELECT CAST(date AS VARCHAR) AS date, metric, value, country FROM history")
def stream_available_now(spark, sf):
    """Events taken as a stream of files; each batch is reduced, batches are summed."""
    work = scratch(spark)
    events = bind.table(spark, sf, "events")
    stream = ingest.parquet_stream(spark, sf, events, glob="events.parquet")

    def step(batch: DataFrame) -> DataFrame:
        return batch.groupBy(
            F.concat(F.lit("Customer#"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("country"),
            F.col("ts").cast("date").alias("date"), C.mapped("event_type", bind.EVENT_METRICS).alias("metric"),
        ).agg(F.count(F.lit(1)).alias("value"))

    ingest.write_batches(stream, f"{work}/out", f"{work}/checkpoint", step).awaitTermination()
    return spark.read.parquet(f"{work}/out").groupBy("date", "metric", "country").agg(F.sum("value").alias("value"))


# --- bucketed tables ---------------------------------------------------------------

BUCKETS = 8


@query(ORACLE["daily_change"])
def bucketed_daily_change(spark, sf):
    """Windows over a created table that is partitioned by day and bucketed by series."""
    prefix = f"b{uuid.uuid4().hex}_"
    failed = {k: v for k, v in writers.create_tables(spark, ("historical",), prefix, buckets=BUCKETS).items() if v}
    failed |= {k: v for k, v in writers.load_tables({"historical": bind.history(spark, sf)}, prefix).items() if v}
    if failed:
        raise ValueError(str(failed))
    return series.with_daily_change(spark.table(f"{prefix}historical")).select(
        "country", "metric", "date", "value", "daily_change", "daily_change_pct")


@query("""SELECT c_custkey, c_name, count(o_orderkey) AS order_count, round(sum(o_totalprice), 2) AS total_price,
  CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_order FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL""")
def bucketed_join(spark, sf):
    """Orders joined to customers and counted by customer, both stored in buckets of the customer's key."""
    prefix = f"b{uuid.uuid4().hex}_"
    customers = writers.store_bucketed(bind.table(spark, sf, "customer"), f"{prefix}customer", ["c_custkey"], BUCKETS)
    orders = writers.store_bucketed(bind.table(spark, sf, "orders"), f"{prefix}orders", ["o_custkey"], BUCKETS)
    joined = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy("c_custkey", "c_name").agg(
        F.count("o_orderkey").alias("order_count"), F.round(F.sum("o_totalprice"), 2).alias("total_price"),
        F.max(F.col("o_orderdate").cast("date")).alias("last_order"))


# --- landing documents ---------------------------------------------------------------
#
# These queries write landing files, tables or streams while they are built: that is what they show.


def _timeline_entry(value: Column) -> Column:
    return F.struct(F.date_format("date", "M/d/yy").alias("key"), value.alias("value"))


@query(f"""WITH {CHANGES} SELECT country, metric, CAST(date AS VARCHAR) AS date, value, daily_change,
  round(avg(value) OVER w, 6) AS value_7day_avg, round(avg(daily_change) OVER w, 6) AS daily_change_7day_avg
  FROM changes WHERE metric IN ('cases', 'deaths', 'recovered') WINDOW w AS (PARTITION BY country, metric ORDER BY date ROWS 6 PRECEDING)""")
def stream_history(spark, sf):
    """Histories whose days are spread over four files, taken one file at a time."""
    work = scratch(spark)
    ensure_checkpoint_dir(spark, f"{work}/checkpoint")
    days = bind.history(spark, sf).withColumn("part", F.dayofmonth("date") % 4)
    pick = lambda m: F.map_from_entries(F.collect_list(F.when(F.col("metric") == m, _timeline_entry(F.col("value")))))
    documents = days.groupBy("part", "country").agg(*[pick(m).alias(m) for m in ("cases", "deaths", "recovered")])
    for part in range(4):
        documents.filter(F.col("part") == part).select("country", F.struct("cases", "deaths", "recovered").alias("timeline")).coalesce(
            1).write.mode("append").json(f"{work}/landing")
    stored = ingest.ingest_available_now(spark, f"{work}/landing", "country_historical", f"{work}/out", f"{work}/marks",
                                         bind.HISTORY_AS_OF, lines=True, max_files=1)
    return rounded(stored.select("country", "metric", "date", "value", "daily_change", "value_7day_avg", "daily_change_7day_avg"),
                   "value_7day_avg", "daily_change_7day_avg")


@query(f"""WITH {CHANGES}, g AS (SELECT country, metric, date, daily_change, value, {_lag_growth(1)}, {_lag_growth(7)}, {_lag_growth(14)}
    FROM changes WINDOW w AS (PARTITION BY country, metric ORDER BY date))
  SELECT country, metric, CAST(date AS VARCHAR) AS date, round(avg(value) OVER w, 6) AS value_7day_avg,
    round(avg(daily_change) OVER w, 6) AS daily_change_7day_avg, growth_rate_1day, growth_rate_7day, growth_rate_14day
  FROM g WINDOW w AS (PARTITION BY country, metric ORDER BY date ROWS 6 PRECEDING)""")
def stream_tail(spark, sf):
    """Histories stored in three appends: some days late by two appends, some values wrong at first; later days in order."""
    work = scratch(spark)
    ensure_checkpoint_dir(spark, f"{work}/checkpoint")
    days = bind.history(spark, sf)
    day = F.dayofmonth("date")
    early, late, wrong = day <= 20, day % 6 == 5, day % 9 == 4
    appends = (
        days.filter(early & ~late).withColumn("value", F.when(wrong, F.col("value") + 100).otherwise(F.col("value"))),
        days.filter(~early),
        days.filter(early & (late | wrong)))
    for number, rows in enumerate(appends):
        tail.advance(spark, rows.withColumn("append", F.lit(number)), work, ["append"], lags=(1, 7, 14))
    return rounded(tail.stored(spark, work).select(
        "country", "metric", "date", "value_7day_avg", "daily_change_7day_avg", "growth_rate_1day", "growth_rate_7day", "growth_rate_14day"),
        "value_7day_avg", "daily_change_7day_avg")


def _drifting_landing(spark, sf) -> str:
    """Customers as payloads of states: some with a field more, some with deaths renamed, some with cases as words."""
    folder = f"{scratch(spark)}/landing"
    key = F.col("c_custkey")
    every = lambda n, c: F.when(key % n == 0, c)
    payload = F.to_json(F.struct(
        F.col("c_name").alias("state"), key.alias("updated"), key.alias("cases"), F.when(key % 3 != 0, key).alias("deaths"),
        every(3, key).alias("deathCount"), key.alias("recovered"), F.col("c_acctbal").alias("casesPerOneMillion"),
        F.col("c_nationkey").alias("population"), every(4, F.col("c_mktsegment")).alias("segment")))
    worded = F.regexp_replace(payload, '"cases":([0-9]+)', '"cases":"some $1"')
    bind.table(spark, sf, "customer").select(F.when(key % 5 == 0, worded).otherwise(payload).alias("value")).write.text(folder)
    return folder


@query("""WITH found AS (
    SELECT 'deathCount' AS field, 'unknown' AS status, 'bigint' AS type, count(*) AS documents FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT 'deaths', 'missing', NULL, count(*) FROM customer WHERE c_custkey % 3 = 0
    UNION ALL SELECT 'segment', 'unknown', 'string', count(*) FROM customer WHERE c_custkey % 4 = 0
    UNION ALL SELECT 'cases', 'retyped', 'string', count(*) FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT 'deathsPerOneMillion', 'missing', NULL, count(*) FROM customer)
  SELECT 'states' AS dataset, * FROM found WHERE documents > 0""")
def payload_drift(spark, sf):
    return drift.drift(drift.documents(spark.read, _drifting_landing(spark, sf), lines=True), "states")


@query("""SELECT c_name AS state, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END AS cases,
    CASE WHEN c_custkey % 3 = 0 THEN c_custkey END AS death_count, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment END AS segment,
    CASE WHEN c_custkey % 5 = 0 THEN 'some ' || c_custkey END AS cases_as_came FROM customer""")
def payload_extras(spark, sf):
    """States with what their schema does not name or cannot read."""
    rows = drift.with_extras(drift.documents(spark.read, _drifting_landing(spark, sf), lines=True), "states")
    extra = lambda name, kind: F.try_variant_get(F.try_element_at("extras", F.lit(name)), "$", kind)
    return readers.from_payload(rows, "states", bind.SNAPSHOT_AS_OF).select(
        "state", "cases", extra("deathCount", "bigint").alias("death_count"), extra("segment", "string").alias("segment"),
        extra("cases", "string").alias("cases_as_came"))


def _broken_landing(spark, sf) -> str:
    """Country histories as JSON lines: a fifth of the documents cut off, deaths of the third of a month no number."""
    folder = f"{scratch(spark)}/landing"
    days = bind.history(spark, sf).filter(F.col("metric").isin("cases", "deaths"))
    value = F.when((F.col("metric") == "deaths") & (F.dayofmonth("date") == 3), "x").otherwise(F.col("value").cast("string"))
    pick = lambda m: F.map_from_entries(F.collect_list(F.when(F.col("metric") == m, _timeline_entry(value))))
    documents = days.groupBy("country").agg(pick("cases").alias("cases"), pick("deaths").alias("deaths"))
    text = F.to_json(F.struct("country", F.struct("cases", "deaths").alias("timeline")))
    broken = F.substring("country", 10, 9).cast("int") % 5 == 0
    documents.select(F.when(broken, F.substring(text, 1, 40)).otherwise(text).alias("value")).write.text(folder)
    return folder


_BROKEN = "CAST(substr(country, 10, 9) AS INT) % 5 = 0"


@query(f"""WITH {HISTORY} SELECT 'malformed document' AS reason, '{{"country":"' || country || '"' AS record
    FROM (SELECT DISTINCT country FROM history WHERE metric IN ('cases', 'deaths') AND {_BROKEN})
  UNION ALL SELECT 'unreadable value', country || ' deaths ' || strftime(date, '%-m/%-d/%y') || ' x' FROM history
    WHERE metric = 'deaths' AND day(date) = 3 AND NOT ({_BROKEN})""")
def read_rejects(spark, sf):
    found = readers.read_rejects(spark, _broken_landing(spark, sf), "country_historical", lines=True)
    return found.select("reason", F.when(F.col("reason") == "malformed document", F.substring("record", 1, 31)).otherwise(
        F.col("record")).alias("record"))


@query(f"""WITH {HISTORY} SELECT CAST(date AS VARCHAR) AS date, metric, value, country FROM history
  WHERE metric IN ('cases', 'deaths') AND NOT ({_BROKEN}) AND NOT (metric = 'deaths' AND day(date) = 3)""")
def country_history_with_rejects(spark, sf):
    return readers.read_series(spark, _broken_landing(spark, sf), "country_historical", bind.HISTORY_AS_OF, lines=True).select(
        "date", "metric", "value", "country")


def _write_landing(spark, sf) -> str:
    """All six data sets as JSON lines: regions, their sums, and the histories."""
    folder = f"{scratch(spark)}/landing"
    regions = bind.snapshot(spark, sf).withColumn("updated", F.unix_millis(F.col("updated").cast("timestamp")))
    sums = [F.sum(c).alias(c) for c in ("cases", "deaths", "recovered", "active", "tests", "population")]
    writers.write_dataset(regions.drop("extraction_date", "data_source", "data_type"), f"{folder}/countries", "json")
    writers.write_dataset(regions.agg(*sums, F.count(F.lit(1)).alias("affectedCountries")), f"{folder}/global", "json")
    writers.write_dataset(regions.groupBy("continent").agg(*sums), f"{folder}/continents", "json")
    suppliers = bind.table(spark, sf, "supplier")
    writers.write_dataset(suppliers.groupBy(F.concat(F.lit("State "), F.col("s_nationkey")).alias("state")).agg(
        F.count(F.lit(1)).alias("cases"), F.count_if(F.col("s_acctbal") < 0).alias("deaths")), f"{folder}/states", "json")
    writers.write_dataset(timelines(spark, sf).select("country", F.col("timeline.cases").alias("timeline")), f"{folder}/vaccines", "json")
    days = bind.global_history(spark, sf)
    pick = lambda m: F.map_from_entries(F.collect_list(F.when(F.col("metric") == m, _timeline_entry(F.col("value")))))
    writers.write_dataset(days.agg(*[pick(m).alias(m) for m in ("cases", "deaths", "recovered")]), f"{folder}/historical", "json")
    return folder


_BUNDLE = f"""WITH {SNAPSHOT}, {HISTORY.strip().replace("history AS", "days AS", 1).replace("'Customer#' || lpad(CAST(user_id AS VARCHAR), 9, '0')", "'Global'")},
  bundle AS (
    SELECT 'global' AS dataset, 'all' AS name, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths FROM snapshot
    UNION ALL SELECT 'countries', country, cases, deaths FROM snapshot
    UNION ALL SELECT 'continents', continent, CAST(sum(cases) AS BIGINT), CAST(sum(deaths) AS BIGINT) FROM snapshot GROUP BY continent
    UNION ALL SELECT 'states', 'State ' || s_nationkey, count(*), count(*) FILTER (s_acctbal < 0) FROM supplier GROUP BY s_nationkey
    UNION ALL SELECT 'historical', CAST(date AS VARCHAR) || metric, value, 0 FROM days WHERE metric IN ('cases', 'deaths', 'recovered'))"""


@query(_BUNDLE + " SELECT * FROM bundle")
def read_bundle(spark, sf):
    """Every data set written as landing documents and read back."""
    data = readers.read_all(spark, _write_landing(spark, sf), bind.SNAPSHOT_AS_OF, days="all", lines=True)
    name = {"global": F.lit("all"), "countries": F.col("country"), "continents": F.col("continent"), "states": F.col("state")}
    parts = [data[d].select(F.lit(d).alias("dataset"), n.alias("name"), "cases", "deaths") for d, n in name.items()]
    parts.append(data["historical"].select(F.lit("historical").alias("dataset"), F.concat(F.col("date").cast("string"), "metric").alias("name"),
                                           F.col("value").alias("cases"), F.lit(0).alias("deaths")))
    return reduce(DataFrame.unionByName, parts)


def _full_run(spark, sf) -> dict:
    """A whole run over all six data sets; its tables are dropped again."""
    prefix = f"r{uuid.uuid4().hex[:12]}_"
    result = runs.run_steps(spark, _write_landing(spark, sf), f"{scratch(spark)}/out", bind.SNAPSHOT_AS_OF, prefix=prefix, days="all", lines=True)
    result["info"] = [writers.table_info(spark, name).first() for name, why in result.get("load", {}).items() if why is None]
    for name in result.get("load", {}):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return result | {"prefix": prefix}


@query(ORACLE["transform_countries"])
def full_run(spark, sf):
    """Regions after a whole run: extracted, transformed, stored, loaded and reconciled."""
    written, = [m for m in _full_run(spark, sf)["transform"] if m["data_type"] == "countries"]
    return readers.read_dataset(spark, written["uri"]).select(
        "country", "region_type", "cases", "deaths", "recovered", "active", "population", "mortality_rate",
        "recovery_rate", "active_rate", "cases_per_million", "deaths_per_million", "processed_at")


_RUN_COUNTS = _BUNDLE + """, numbers AS (SELECT dataset, count(*) AS n FROM bundle GROUP BY dataset
    UNION ALL SELECT 'vaccines', count(DISTINCT user_id) FROM events)"""


@query(_RUN_COUNTS + " SELECT dataset AS table_name, n AS expected_count, n AS actual_count, true AS count_match FROM numbers")
def run_reconcile(spark, sf):
    """What a run's load step finds when it compares each table with the manifest."""
    result = _full_run(spark, sf)
    return spark.createDataFrame(
        [(r["table_name"].removeprefix(result["prefix"]), r["expected_count"], r["actual_count"], r["count_match"]) for r in result["reconcile"]],
        "table_name STRING, expected_count BIGINT, actual_count BIGINT, count_match BOOLEAN")


@query(_RUN_COUNTS + """ SELECT 'load' AS step, dataset, n AS record_count FROM numbers UNION ALL SELECT 'removed', dataset, 0 FROM numbers
  UNION ALL SELECT 'rejected', dataset, 0 FROM numbers
  UNION ALL SELECT task, 'success', (SELECT CAST(sum(n) AS BIGINT) FROM numbers) FROM (SELECT unnest(['extract', 'transform', 'store', 'load']) AS task)""")
def run_books(spark, sf):
    """The bookkeeping of a run: rows of its tables, rows removed and rejected, and its steps."""
    result = _full_run(spark, sf)
    rows = [("load", r["table_name"].removeprefix(result["prefix"]), r["record_count"]) for r in result["info"]]
    rows += [("removed", dataset, n) for dataset, n in result["removed"].items()]
    rows += [("rejected", m["data_type"], m["record_count"]) for m in result["rejects"]]
    rows += [(s["task_name"], s["status"], s["records_processed"]) for s in result["steps"]]
    return spark.createDataFrame(rows, "step STRING, dataset STRING, record_count BIGINT")


@query(_RUN_COUNTS + """ SELECT count(*) AS datasets, CAST(sum(n) AS BIGINT) AS total_records, 1 AS steps_succeeded, 0 AS steps_partial, 0 AS steps_failed FROM numbers""")
def single_step_summary(spark, sf):
    """The summary of a run of which only the first step was asked for."""
    result = runs.run_steps(spark, _write_landing(spark, sf), f"{scratch(spark)}/out", bind.SNAPSHOT_AS_OF, step="extract", days="all", lines=True)
    return runs.run_summary(writers.manifest_frame(spark, result["extract"]), writers.run_log(spark, result["steps"])).drop("duration_seconds")


@query(f"""WITH {SNAPSHOT}, loaded AS (SELECT 'countries' AS dataset, cases, deaths FROM snapshot
    UNION ALL SELECT 'continents', CAST(sum(cases) AS BIGINT), CAST(sum(deaths) AS BIGINT) FROM snapshot GROUP BY continent)
  SELECT run, dataset, count(*) AS row_count, CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths
  FROM loaded, (SELECT unnest(['cut off', 'once', 'twice']) AS run) GROUP BY run, dataset""")
def load_again(spark, sf):
    """Loads of a run that are repeated, of another run, and of one that was cut off: each table has each run once."""
    ensure_checkpoint_dir(spark, scratch(spark))
    regions = bind.snapshot(spark, sf)
    bundle = {"countries": regions, "continents": regions.groupBy("continent").agg(
        F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"), F.max("extraction_date").alias("extraction_date"))}
    prefix = f"r{uuid.uuid4().hex[:12]}_"
    for run, parts in (("twice", bundle), ("once", bundle), ("cut off", {"countries": regions.limit(5)}), ("twice", bundle), ("cut off", bundle)):
        failed = {k: v for k, v in writers.load_tables(parts, prefix, run_id=run).items() if v}
        if failed:
            raise RuntimeError(str(failed))
    tables = [spark.table(f"{prefix}{d}").select(F.lit(d).alias("dataset"), S.RUN_COLUMN, "cases", "deaths") for d in bundle]
    out = reduce(DataFrame.unionByName, tables).groupBy(F.col(S.RUN_COLUMN).alias("run"), "dataset").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths")).checkpoint()
    for d in bundle:
        spark.sql(f"DROP TABLE {prefix}{d}")
    return out


_CHANGED = """WITH ends AS (SELECT o_orderpriority, min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders GROUP BY o_orderpriority),
  changed AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' AND o_orderkey = a THEN (SELECT o_custkey FROM orders x WHERE x.o_orderkey = b)
      WHEN o_orderpriority = '2-HIGH' AND o_orderkey = b THEN (SELECT o_custkey FROM orders x WHERE x.o_orderkey = a) ELSE o_custkey END AS o_custkey,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey = a THEN o_totalprice + 0.01 ELSE o_totalprice END AS o_totalprice,
    o_orderpriority FROM orders JOIN ends USING (o_orderpriority)),
  given AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders)"""


@query(_CHANGED + """, odd AS (SELECT DISTINCT o_orderpriority FROM ((SELECT * FROM given EXCEPT ALL SELECT * FROM changed) UNION ALL
      (SELECT * FROM changed EXCEPT ALL SELECT * FROM given)))
  SELECT o_orderpriority, count(*) AS expected_count, count(*) AS actual_count, true AS count_match,
    o_orderpriority NOT IN (SELECT o_orderpriority FROM odd) AS content_match FROM orders GROUP BY o_orderpriority""")
def reconcile_digest(spark, sf):
    """At equal counts: one cell changed in the urgent orders, two customers swapped in the high ones."""
    orders = bind.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    ends = orders.groupBy("o_orderpriority").agg(F.min_by("o_custkey", "o_orderkey").alias("a_cust"), F.min("o_orderkey").alias("a"),
                                                 F.max_by("o_custkey", "o_orderkey").alias("b_cust"), F.max("o_orderkey").alias("b"))
    high, urgent = (F.col("o_orderpriority") == p for p in ("2-HIGH", "1-URGENT"))
    stored = orders.join(ends, "o_orderpriority").select(
        "o_orderpriority", "o_orderkey",
        F.when(high & (F.col("o_orderkey") == F.col("a")), F.col("b_cust")).when(high & (F.col("o_orderkey") == F.col("b")), F.col("a_cust"))
        .otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.when(urgent & (F.col("o_orderkey") == F.col("a")), F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")).alias("o_totalprice"))
    return writers.reconcile_content(stored, orders, ["o_orderpriority"]).drop("expected_digest", "actual_digest")


@query("""SELECT c_name AS country, CASE WHEN c_custkey % 2 = 0 THEN c_custkey * 10 ELSE c_custkey END AS cases FROM customer""")
def dedup_across_files(spark, sf):
    """An older file of all regions and a newer, smaller one of half of them."""
    folder = scratch(spark)
    regions = bind.table(spark, sf, "customer")
    for name, part, times in (("c_20240501", regions, 1), ("c_20240502", regions.filter("c_custkey % 2 = 0"), 10)):
        part.select(F.to_json(F.struct(F.col("c_name").alias("country"), (F.col("c_custkey") * times).alias("cases"))).alias("value")).write.text(
            f"{folder}/{name}")      # the names of the folders carry the order
    rows = readers.read_snapshot(spark, [f"{folder}/c_20240501", f"{folder}/c_20240502"], "countries", bind.SNAPSHOT_AS_OF, lines=True)
    return dedup.dedup(rows, "countries", transforms.dedup_order(rows, "countries")).select("country", "cases")


# --- what does not fit ------------------------------------------------------------------


@query("""SELECT 'cases_per_one_million' AS column_name, count(*) FILTER (o_totalprice * 1000 >= 99999999.995) AS not_castable, 0 AS too_long FROM orders
  UNION ALL SELECT 'country', 0, count(*) FROM orders UNION ALL SELECT 'population', count(*) FILTER (o_custkey % 2 = 0), 0 FROM orders""")
def conform_misfits(spark, sf):
    rows = bind.table(spark, sf, "orders").select(
        F.repeat("o_orderpriority", 60).alias("country"), (F.col("o_totalprice") * 1000).alias("cases_per_one_million"),
        F.when(F.col("o_custkey") % 2 == 0, "many").otherwise("5").alias("population"))
    return writers.misfits(rows, "countries")


@query("SELECT c_custkey, c_mktsegment[1:1] || lower(c_mktsegment[2:]) AS place FROM customer")
def title_case_blanks(spark, sf):
    """Names between tabs, line breaks and no-break spaces."""
    padded = F.concat(F.lit("\t \u00a0"), F.lower("c_mktsegment"), F.lit("\u2003\r\n"))
    return bind.table(spark, sf, "customer").select("c_custkey", C.title_case(padded).alias("place"))


@query("""WITH n AS (SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('view', 'click', 'purchase') GROUP BY event_type)
  SELECT 'unknown_metric: found ' || sum(n) || ' rows with an unknown metric: ' ||
    string_agg(event_type || ' (' || n || ')', ', ' ORDER BY n DESC, event_type) AS warning FROM n""")
def unknown_metrics(spark, sf):
    rows = bind.table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("date"), C.mapped("event_type", bind.EVENT_METRICS).alias("metric"), F.lit(1).alias("value"),
        F.col("user_id").cast("string").alias("country"))
    found = quality.validate(rows, "historical", bind.HISTORY_AS_OF).select(F.explode("warnings").alias("warning"))
    return found.filter(F.col("warning").startswith("unknown_metric"))


@query("""WITH found AS (
    SELECT 'customer' AS dataset, count(*) AS n, 5 AS k, count(*) FILTER (c_name IS NULL) AS unreadable FROM customer
    UNION ALL SELECT 'orders', count(*), 6, count(*) FILTER (o_totalprice > 1000 AND o_orderstatus = 'P') FROM orders
    UNION ALL SELECT 'supplier', count(*), 4, count(*) FILTER (s_acctbal > 1e9) FROM supplier
    UNION ALL SELECT 'events', count(*), 6, count(*) FILTER (event_type = 'purchase') FROM events)
  SELECT dataset, CASE WHEN unreadable = 0 THEN n END AS record_count, k AS column_count, unreadable = 0 AND n > 0 AS is_valid,
    unreadable = 0 AND n BETWEEN 1 AND 99 AS few, unreadable > 0 AS failed, CASE WHEN unreadable > 0 THEN 0.0 END AS failed_score FROM found""")
def validations(spark, sf):
    """Whole tables validated side by side; those with a value that cannot be read give a failed result, the others theirs."""
    bad = lambda test: F.when(~test, F.lit(0)).otherwise(F.raise_error(F.lit("unreadable")).cast("int")) == 0
    spoilt = {
        "customer": F.col("c_name").isNull(), "orders": (F.col("o_totalprice") > 1000) & (F.col("o_orderstatus") == "P"),
        "supplier": F.col("s_acctbal") > 1e9, "events": F.col("event_type") == "purchase"}
    found = reduce(DataFrame.unionByName, [
        quality.validated(bind.table(spark, sf, name).filter(bad(test)), name, bind.SNAPSHOT_AS_OF, min_records=100, max_null_share=1.0)
        for name, test in spoilt.items()])
    failed = F.coalesce(F.startswith(F.get("errors", F.lit(0)), F.lit("validation failed")), F.lit(False))
    few = F.exists("warnings", lambda w: F.startswith(w, F.lit("min_rows")))      # a warning, no error
    return found.select("dataset", "record_count", "column_count", "is_valid", few.alias("few"), failed.alias("failed"),
                        F.when(failed, F.col("quality_score")).alias("failed_score"))


@query(f"""WITH {HISTORY}, kept AS (SELECT country, date, metric, CAST(value AS BIGINT) AS value FROM history WHERE metric IN ('cases', 'deaths', 'recovered'))
  SELECT country, metric, CAST(date AS VARCHAR) AS date, value FROM kept""")
def dedup_nested_rows(spark, sf):
    """Documents with nested maps, delivered twice: every entry of those that stay, so a wrong or second document shows."""
    documents = timelines(spark, sf)
    unique = dedup.dedup_rows(documents.unionByName(documents))
    entries = reduce(DataFrame.unionByName, [
        unique.select("country", F.lit(m).alias("metric"), F.explode(f"timeline.{m}").alias("key", "value")) for m in ("cases", "deaths", "recovered")])
    return entries.select("country", "metric", F.to_date("key", S.SERIES_DATE_FORMAT).alias("date"), F.col("value").cast("bigint"))


@query("SELECT 'countries' AS dataset, false AS is_valid, 0.0 AS quality_score, 'validation failed' AS error, CAST(NULL AS BIGINT) AS record_count")
def failed_validation(spark, sf):
    """A data set that cannot be read to its end is a validation result, not the end of the run."""
    rows = bind.snapshot(spark, sf).withColumn("cases", F.when(F.col("cases") >= 0, F.raise_error(F.lit("unreadable"))).cast("bigint"))
    row = quality.validated(rows, "countries", bind.SNAPSHOT_AS_OF)
    return row.select("dataset", "is_valid", "quality_score", F.substring(F.col("errors")[0], 1, 17).alias("error"), "record_count")


@query("""WITH facts AS (
    SELECT count(*) FILTER (trunc(o_totalprice) - 100000 < 0) AS low, count(*) FILTER (o_orderkey % 7 - 1 < 0) AS recovered FROM orders),
  codes AS (SELECT count(*) FILTER (length(c_mktsegment[1:c_custkey % 4]) <> 2) AS two, count(*) FILTER (length(c_name[1:3]) <> 3) AS three FROM customer)
  SELECT x.dataset, x.check_name, x.severity, CAST(x.observed AS DOUBLE) AS observed, CASE WHEN x.observed > 0 THEN 'FAIL' ELSE 'PASS' END AS status
  FROM facts, codes, LATERAL (VALUES ('global', 'numeric_cases', 'error', 0), ('global', 'numeric_deaths', 'error', 1), ('global', 'numeric_recovered', 'error', 0),
    ('global', 'negative_cases', 'warning', low), ('global', 'negative_recovered', 'warning', recovered),
    ('countries', 'length_country_iso2', 'warning', two), ('countries', 'length_country_iso3', 'warning', three)) AS x(dataset, check_name, severity, observed)""")
def check_types_and_codes(spark, sf):
    """Columns that should be numbers, negative counts, and lengths of codes; with failures of each kind."""
    totals = bind.table(spark, sf, "orders").select(
        (F.col("o_totalprice").cast("bigint") - 100000).alias("cases"), F.col("o_orderstatus").alias("deaths"),
        (F.col("o_orderkey") % 7 - 1).alias("recovered"))
    codes = bind.table(spark, sf, "customer").select(
        F.col("c_name").alias("country"), F.expr("substring(c_mktsegment, 1, int(c_custkey % 4))").alias("country_iso2"),
        F.substring("c_name", 1, 3).alias("country_iso3"))
    found = quality.check_results(totals, "global", bind.SNAPSHOT_AS_OF).unionByName(quality.check_results(codes, "countries", bind.SNAPSHOT_AS_OF))
    return found.filter(F.col("check_name").rlike("^(numeric|negative|length)_")).select("dataset", "check_name", "severity", "observed", "status")


@query("""SELECT 'customer' AS dataset, CAST(sum(24 + coalesce(strlen(c_name), 0) + coalesce(strlen(c_mktsegment), 0)) AS BIGINT) AS bytes FROM customer
  UNION ALL SELECT 'documents', CAST(sum(16 + coalesce(strlen(text), 0) + coalesce(strlen(lang), 0) + coalesce(strlen(source), 0)) AS BIGINT) FROM documents""")
def size_estimate(spark, sf):
    """Size in memory of whole tables: 8 bytes a number, the encoded length of a text."""
    sized = [(n, bind.table(spark, sf, n)) for n in ("customer", "documents")]
    return reduce(DataFrame.unionByName, [df.agg(quality.estimated_bytes(df).alias("bytes")).select(F.lit(n).alias("dataset"), "bytes") for n, df in sized])


@query("""SELECT CAST(sum(strlen(text) + 1) AS BIGINT) AS total_size_bytes FROM (
    SELECT c_name || ',' || c_mktsegment AS text FROM customer UNION ALL SELECT o_orderstatus || ',' || o_orderkey FROM orders)""")
def file_sizes(spark, sf):
    """Bytes of all files under a folder of two tables stored as plain lines."""
    folder = f"{scratch(spark)}/files"
    for name, columns in (("customer", ("c_name", "c_mktsegment")), ("orders", ("o_orderstatus", "o_orderkey"))):
        bind.table(spark, sf, name).select(F.concat_ws(",", *columns).alias("value")).write.text(f"{folder}/{name}")
    return writers.storage_info(writers.file_inventory(spark, folder)).select("total_size_bytes")


@query(f"""WITH {HISTORY} SELECT country, CAST(date AS VARCHAR) AS date, value AS doses, 'vaccination' AS data_category FROM history
  WHERE metric = 'recovered'""")
def vaccines_category(spark, sf):
    rows = readers.vaccines_long(timelines(spark, sf).select("country", F.col("timeline.recovered").alias("timeline")))
    return clean.with_region(rows, "vaccines").select("country", "date", "doses", "data_category")


@query("""WITH counted AS (SELECT 'customer' AS table_name, count(*) AS record_count, count(*) AS expected_count FROM customer
    UNION ALL SELECT 'orders', count(*), (SELECT count(DISTINCT l_orderkey) + 1 FROM lineitem) FROM orders)
  SELECT *, 2 AS loads, expected_count = record_count AS count_match, true AS is_valid FROM counted""")
def quality_table(spark, sf):
    """Validation results of whole tables in the data quality table, appended by two runs, beside the counts a manifest expects."""
    name = f"q{uuid.uuid4().hex}"
    tables = {n: bind.table(spark, sf, n) for n in ("customer", "orders")}
    expected = {"customer": tables["customer"].count(),
                "orders": bind.table(spark, sf, "lineitem").select("l_orderkey").distinct().count() + 1}
    results = reduce(DataFrame.unionByName, [quality.validated(df, n, bind.SNAPSHOT_AS_OF, max_null_share=1.0) for n, df in tables.items()])
    for day in ("2001-08-02 12:00:00", "2001-08-03 12:00:00"):
        writers.write_quality(results, name, day, expected)
    return spark.table(name).groupBy("table_name", "record_count", "expected_count", "count_match", "is_valid").agg(
        F.count(F.lit(1)).alias("loads"))


_HISTORY_CHECKS = ("q_date_gaps", "q_large_negative_changes", "q_completeness_major", "q_historical_vs_current")


@query(" UNION ALL ".join(f"SELECT * FROM ({ORACLE[name]})" for name in _HISTORY_CHECKS) + f"""
  UNION ALL (WITH {SNAPSHOT} SELECT 'countries', 'minimum_record_count', count(*), CASE WHEN count(*) < 190 THEN 'FAIL' ELSE 'PASS' END FROM snapshot)
  UNION ALL (WITH {SNAPSHOT} SELECT 'countries', 'recent_data', date_diff('hour', max(extraction_date), {NOW_H}),
    CASE WHEN date_diff('hour', max(extraction_date), {NOW_H}) <= 24 THEN 'PASS' ELSE 'FAIL' END FROM snapshot)""")
def all_checks(spark, sf):
    """History checks, minimum counts and ages among all check rows."""
    countries = bind.rated_snapshot(spark, sf)
    rows = checks.all_checks(
        countries, series.with_daily_change(bind.history(spark, sf)), bind.HISTORY_AS_OF, tables={"countries": countries},
        history_limits={"q_completeness_major": {"min_cases": 5}, "q_historical_vs_current": {"min_cases": 5},
                        "q_large_negative_changes": {"limit": -1}})
    names = [name.removeprefix("q_") for name in _HISTORY_CHECKS[:2]] + [
        "completeness_major_countries", "historical_vs_current", "minimum_record_count", "recent_data"]
    return rows.filter(F.col("check_type").isin(names))
