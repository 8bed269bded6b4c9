"""Reporting views and analyses over snapshots and histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapstats.operators import ranks, series

# Columns of the latest-statistics view, and of the ranked view.
LATEST_COLUMNS = (
    "country", "continent", "cases", "deaths", "recovered", "active", "mortality_rate", "recovery_rate",
    "cases_per_million", "deaths_per_million", "population", "updated", "extraction_date",
)
RANKED_COLUMNS = (
    "country", "continent", "cases", "deaths", "mortality_rate", "cases_per_million", "deaths_per_million",
    "population",
)
RANKS = {"cases": "cases_rank", "deaths": "deaths_rank", "mortality_rate": "mortality_rank"}


def latest_rows(df: DataFrame) -> DataFrame:
    """View columns of the newest extraction, unordered."""
    return series.latest_only(df).select(*LATEST_COLUMNS)


def latest_stats(df: DataFrame) -> DataFrame:
    """Statistics of the newest extraction, most cases first."""
    return latest_rows(df).orderBy(F.desc("cases"), "country")


def global_trends(history: DataFrame) -> DataFrame:
    """Per date of the global series: totals per metric and mean daily changes, newest first."""
    pick = lambda metric, column: F.when(F.col("metric") == metric, F.col(column))
    return history.filter(F.col("country") == "Global").groupBy("date").agg(
        *[F.sum(pick(m, "value")).alias(f"total_{m}") for m in ("cases", "deaths", "recovered")],
        *[F.avg(pick(m, "daily_change")).alias(f"avg_daily_{m}") for m in ("cases", "deaths")],
    ).orderBy(F.desc("date"))


def top_affected(df: DataFrame, n: int = 50, min_cases: int = 1000) -> DataFrame:
    """Most affected regions of the newest extraction with their ranks among all larger ones."""
    larger = latest_rows(df).filter(F.col("cases") > min_cases).select(*RANKED_COLUMNS)
    return ranks.top_ranked(larger, "cases", RANKS, n, tiebreak=["country"])


def global_kpis(df: DataFrame) -> DataFrame:
    """Headline figures of the newest global row."""
    names = [c for c in (
        "cases", "deaths", "recovered", "active", "critical", "mortality_rate", "recovery_rate",
        "affected_countries", "affectedcountries", "cases_per_million", "deaths_per_million",
        "casesperonemillion", "deathsperonemillion", "updated", "processed_at") if c in df.columns]
    return series.latest_only(df).select(*names)


def top_n(df: DataFrame, key: str, n: int = 10, by: str = "cases", where: Column | None = None,
          columns=("cases", "deaths")) -> DataFrame:
    """First ``n`` regions by a column, with mortality percent (missing rate as 0)."""
    rows = df if where is None else df.filter(where)
    percent = F.coalesce(F.col("mortality_rate"), F.lit(0.0)) * 100
    return rows.select(key, *columns, *([by] if by not in columns and by != "mortality_rate" else []),
                       "mortality_rate", percent.alias("mortality_pct")).orderBy(
        F.desc_nulls_last(by), F.asc(key)).limit(n)


def ranked_by(df: DataFrame, key: str, by: str = "cases") -> DataFrame:
    """All regions by a column, with mortality percent."""
    percent = F.coalesce(F.col("mortality_rate"), F.lit(0.0)) * 100
    return df.select(key, "cases", "deaths", percent.alias("mortality_pct")).orderBy(F.desc(by), F.asc(key))


def top_mortality(df: DataFrame, key: str, n: int = 15, min_cases: int = 100_000) -> DataFrame:
    """Highest mortality among regions with many cases."""
    return top_n(df, key, n, by="mortality_rate", where=F.col("cases") > min_cases)


def rollup_by(df: DataFrame, key: str = "continent", columns=("cases", "deaths", "recovered")) -> DataFrame:
    """Sums per group, largest first."""
    present = [c for c in columns if c in df.columns]
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in present]).orderBy(F.desc(present[0]), F.asc(key))


def share_of_total(df: DataFrame, key: str = "continent", column: str = "cases") -> DataFrame:
    """Sum per group and its percentage of the whole."""
    sums = df.groupBy(key).agg(F.sum(column).alias(column))
    whole = sums.agg(F.sum(column)).scalar()      # from the group sums: no second scan
    return sums.withColumn("share_pct", F.try_divide(F.col(column) * F.lit(100.0), whole)).orderBy(
        F.desc(column), F.asc(key))


def summary_stats(df: DataFrame) -> DataFrame:
    """Totals, mortality mean / max / min, number of regions, regions without deaths."""
    rate = F.col("mortality_rate")
    return df.agg(
        F.count(F.lit(1)).alias("regions"), F.sum("cases").alias("total_cases"), F.sum("deaths").alias("total_deaths"),
        F.avg(rate).alias("avg_mortality"), F.max(rate).alias("max_mortality"), F.min(rate).alias("min_mortality"),
        F.count_if(F.col("deaths") == 0).alias("regions_without_deaths"))


def records_per_dataset(bundle: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("dataset"), "record_count")
        for name, df in bundle.items()
    ])


def sample_rows(df: DataFrame, columns, n: int = 3, key: str | None = None) -> DataFrame:
    """First ``n`` rows by ``key`` (the first listed column unless given), listed columns only."""
    return df.orderBy(key or columns[0]).select(*columns).limit(n)


def lineage(df: DataFrame) -> DataFrame:
    """Where a row came from and when it was handled."""
    return df.select(*[c for c in ("updated", "extraction_date", "processed_at", "data_source") if c in df.columns])
