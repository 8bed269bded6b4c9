"""Completeness checks: calendar, members, metrics, coverage, recency and scores.

Rows read (check_category, check_name, count, status) unless stated otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapstats import schemas as S
from snapstats.functions import columns as C
from snapstats.operators import clean


def check_row(counted: DataFrame, category: str, name: str, allowed: int) -> DataFrame:
    return counted.select(
        F.lit(category).alias("check_category"), F.lit(name).alias("check_name"), "count",
        C.status(F.col("count") > allowed).alias("status"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def _recent(history: DataFrame, as_of, days: int) -> DataFrame:
    return history.filter(F.col("date") >= F.date_sub(clean.clock(as_of).cast("date"), days))


def missing_dates(df: DataFrame, column: str = "date") -> DataFrame:
    """Days between the first and last date that have no row.

    The data shrinks to its distinct days first; the calendar is as long as the span.
    """
    present = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("date").alias("day")).distinct()
    span = present.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).filter(F.col("lo").isNotNull())
    calendar = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return calendar.join(present, "day", "left_anti").withColumnRenamed("day", "expected_date")


def m_missing_dates(df: DataFrame, column: str = "date", allowed: int = 7) -> DataFrame:
    return check_row(_count(missing_dates(df, column)), "temporal_completeness", "missing_dates_historical", allowed)


def m_missing_recent(countries: DataFrame, history: DataFrame, as_of, min_cases: int = 1000, days: int = 7,
                     allowed: int = 10) -> DataFrame:
    """Countries of some size without a history row in the last days."""
    recent = _recent(history, as_of, days).select("country").distinct()
    expected = countries.filter(F.col("cases") > min_cases).select("country").distinct()
    return check_row(_count(expected.join(recent, "country", "left_anti")),
                     "temporal_completeness", "countries_missing_recent_data", allowed)


def missing_members(df: DataFrame, column: str, expected) -> DataFrame:
    """Expected values that never occur. Only expected values are kept from the data,
    so both sides of the anti join are at most as long as the list."""
    members = df.sparkSession.createDataFrame([(e,) for e in expected], "member STRING")
    found = df.filter(F.col(column).isin(list(expected))).select(F.col(column).alias("member")).distinct()
    return members.join(found, "member", "left_anti")


def m_missing_members(df: DataFrame, column: str, expected, name: str, allowed: int) -> DataFrame:
    return check_row(_count(missing_members(df, column, expected)), "geographical_completeness", name, allowed)


def m_missing_continents(countries: DataFrame, expected=S.EXPECTED_CONTINENTS, allowed: int = 0) -> DataFrame:
    return m_missing_members(countries, "continent", expected, "missing_continents", allowed)


def m_missing_countries(countries: DataFrame, expected=S.EXPECTED_COUNTRIES, allowed: int = 2) -> DataFrame:
    return m_missing_members(countries, "country", expected, "missing_major_countries", allowed)


def m_missing_states(states: DataFrame, expected=S.EXPECTED_STATES, allowed: int = 3) -> DataFrame:
    return m_missing_members(states, "state", expected, "missing_major_states", allowed)


def metric_tests(deaths_min_cases: int = 100) -> dict[str, tuple[Column, int]]:
    """Name -> (row lacks the metric, tolerated rows)."""
    return {
        "countries_missing_cases": (F.col("cases").isNull(), 5),
        "countries_missing_deaths": (F.col("deaths").isNull() & (F.col("cases") > deaths_min_cases), 10),
        "countries_missing_population": (F.col("population").isNull() | (F.col("population") == 0), 20),
    }


def metric_checks(countries: DataFrame, only=None, **limits) -> DataFrame:
    """Missing cases, deaths and population in one pass; ``only`` picks some by name."""
    picked = {k: v for k, v in metric_tests(**limits).items() if only is None or k in only}
    rows = F.array(*[
        F.struct(F.lit("metric_completeness").alias("check_category"), F.lit(name).alias("check_name"),
                 F.count_if(test).alias("count"), C.status(F.count_if(test) > allowed).alias("status"))
        for name, (test, allowed) in picked.items()
    ])
    return countries.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*")


def metric_day_counts(history: DataFrame, as_of, days: int = 30, exclude: str = "Global") -> DataFrame:
    """Per country: distinct days of each metric and overall.

    One row per country and day comes first (which metrics it has), then plain sums:
    no distinct count needs its own copy of the rows.
    """
    recent = _recent(history, as_of, days).filter(F.col("country") != exclude)
    per_day = recent.groupBy("country", "date").agg(*[
        F.max((F.col("metric") == m).cast("int")).alias(m) for m in S.METRICS
    ])
    return per_day.groupBy("country").agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(f"{m}_days") for m in S.METRICS], F.count("date").alias("total_days"))


def m_metric_days(history: DataFrame, as_of, days: int = 30, min_share: float = 0.8, allowed: int = 50) -> DataFrame:
    """Countries whose cases or deaths cover too few of their days."""
    counts = metric_day_counts(history, as_of, days)
    needed = F.col("total_days") * min_share
    short = counts.filter((F.col("cases_days") < needed) | (F.col("deaths_days") < needed))
    return check_row(_count(short), "metric_completeness", "historical_metrics_incomplete", allowed)


def m_group_coverage(countries: DataFrame, group: str = "continent", min_percent: float = 80) -> DataFrame:
    """Per group: members, members with cases, coverage percent, status; best first."""
    n, with_cases = F.count(F.lit(1)), F.count_if(F.col("cases") > 0)
    return (
        countries.filter(C.is_filled(group)).groupBy(group)
        .agg(n.alias("countries_count"), with_cases.alias("countries_with_cases"))
        .withColumn("share", F.col("countries_with_cases") * F.lit(100.0) / F.col("countries_count"))
        .select(F.lit("coverage_analysis").alias("check_category"), F.lit(f"{group}_coverage").alias("check_name"),
                group, "countries_count", "countries_with_cases", F.round("share", 2).alias("coverage_percentage"),
                C.status(F.col("share") < min_percent).alias("status"))
        .orderBy(F.desc("coverage_percentage"), group)
    )


def m_recency(tables: list[DataFrame], as_of, max_hours: float = 24) -> DataFrame:
    """Per source and data type over all tables: newest extraction, rows, age in hours."""
    rows = reduce(DataFrame.unionByName, [t.select("data_source", "data_type", "extraction_date") for t in tables])
    age = C.hours_between(clean.clock(as_of), F.col("latest_extraction"))
    return (
        rows.groupBy("data_source", "data_type")
        .agg(F.max("extraction_date").alias("latest_extraction"), F.count(F.lit(1)).alias("record_count"))
        .withColumn("hours_old", age)
        .select(F.lit("coverage_analysis").alias("check_category"), F.lit("data_recency").alias("check_name"), "*",
                F.when(F.col("hours_old") <= max_hours, "PASS").otherwise("FAIL").alias("status"))
        .orderBy(F.desc("latest_extraction"), "data_source", "data_type")
    )


_SCORED = ("country", "cases", "deaths", "population")


def m_scores(countries: DataFrame, history: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Completeness percentages of countries and recent history, their mean and grade."""
    n = F.count(F.lit(1))
    of_countries = countries.agg(
        F.lit("countries").alias("data_type"), n.alias("total_records"),
        F.count_if(C.is_filled("country")).alias("country"), F.count("cases").alias("cases"),
        F.count("deaths").alias("deaths"), F.count_if(F.col("population") > 0).alias("population"))
    of_history = _recent(history, as_of, days).agg(
        F.lit("historical").alias("data_type"), n.alias("total_records"),
        n.alias("country"), F.count("value").alias("cases"), n.alias("deaths"), n.alias("population"))
    percent = {
        f"{c}_completeness": F.round(F.try_divide(F.col(c) * F.lit(100.0), F.col("total_records")), 2)
        for c in _SCORED
    }
    scored = of_countries.unionByName(of_history).select(
        "data_type", "total_records", *[p.alias(name) for name, p in percent.items()])
    mean = reduce(lambda a, b: a + b, [F.col(name) for name in percent]) / 4
    bands = [("EXCELLENT", mean >= 95), ("GOOD", mean >= 90), ("FAIR", mean >= 80)]
    return scored.select(
        F.lit("completeness_scoring").alias("check_category"), F.lit("overall_completeness").alias("check_name"), "*",
        F.round(mean, 2).alias("avg_completeness"), C.grade(mean, bands, "POOR").alias("completeness_grade"))


def m_summary(countries: DataFrame, history: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Dashboard row with a JSON object of totals.

    Each table is reduced to one row per member first, in a single pass; members are
    counted on that.
    """
    recent = _recent(history, as_of, days)

    def side(df: DataFrame, members: list[str], continents: Column) -> DataFrame:
        per_member = df.groupBy(*members).agg(
            F.max("extraction_date").alias("latest"), F.count(F.lit(1)).alias("n"))
        return per_member.agg(
            F.max("latest").alias("latest_data"), F.coalesce(F.sum("n"), F.lit(0)).alias("records"),
            F.count_distinct("country").alias("total_countries"), continents.alias("total_continents"))

    both = side(countries, ["country", "continent"], F.count_distinct("continent")).unionByName(
        side(recent, ["country"], F.lit(0).cast("bigint")))
    totals = both.agg(
        F.max("total_countries").alias("total_countries"), F.max("total_continents").alias("total_continents"),
        F.max("latest_data").alias("latest_data"), F.sum("records").alias("total_records"))
    metrics = F.to_json(F.struct(
        "total_countries", "total_continents",
        F.date_format("latest_data", "yyyy-MM-dd HH:mm:ss").alias("latest_data"),
        C.hours_between(clean.clock(as_of), F.col("latest_data")).alias("data_age_hours"), "total_records"))
    return totals.select(
        F.lit("completeness_summary").alias("report_type"), clean.clock(as_of).alias("report_timestamp"),
        F.lit("Data completeness validation completed").alias("status"), metrics.alias("summary_metrics"))
