"""Quality checks over snapshot and history tables.

Every check is a row (table_name, check_type, count, status). Row-level checks of one
table share a single pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapstats import schemas as S
from snapstats.functions import columns as C
from snapstats.operators import clean, dedup, joins, series

COLUMNS = ("table_name", "check_type", "count", "status")


def check_row(counted: DataFrame, table: str, name: str, allowed: int = 0) -> DataFrame:
    """Turn a one-row frame with column ``count`` into a check row."""
    return counted.select(
        F.lit(table).alias("table_name"), F.lit(name).alias("check_type"), "count",
        C.status(F.col("count") > allowed).alias("status"))


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("count"))


def row_check_tests(as_of, freshness_hours: int = 48, max_mortality: float = 0.20, mortality_min_cases: int = 1000,
                    mortality_allowed: int = 100, active_tolerance: float = 0.01,
                    active_min_cases: int = 100) -> dict[str, tuple[Column, int]]:
    """Name -> (failing row test, tolerated rows) of the row-level country checks."""
    cases, deaths, recovered, active = map(F.col, ("cases", "deaths", "recovered", "active"))
    stale = clean.clock(as_of) - F.expr(f"INTERVAL {int(freshness_hours)} HOURS")
    return {
        "null_country_names": (C.is_blank("country"), 0),
        "negative_cases": (C.any_negative("cases", "deaths", "recovered"), 0),
        "data_freshness": (F.col("updated") < stale, 0),
        "cases_consistency": ((cases < deaths + recovered) & (cases > 0), 0),
        "mortality_rate_check": (
            (F.col("mortality_rate") > max_mortality) & (cases > mortality_min_cases), mortality_allowed),
        "active_cases_calculation": (
            C.off_by_more_than(active, cases - deaths - recovered, cases * active_tolerance)
            & (cases > active_min_cases), 0),
    }


def row_checks(df: DataFrame, tests: dict[str, tuple[Column, int]], table: str = "countries", only=None,
               min_records: int | None = None) -> DataFrame:
    """Evaluate row tests in one pass; ``only`` picks some by name.

    ``min_records`` adds the check that the table has at least that many rows.
    """
    counts = {
        name: (F.count_if(test), F.count_if(test) > allowed)
        for name, (test, allowed) in tests.items() if only is None or name in only
    }
    if min_records is not None:
        rows = F.count(F.lit(1))
        counts["minimum_record_count"] = (rows, rows < min_records)
    results = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("check_type"), count.alias("count"),
                 C.status(failed).alias("status"))
        for name, (count, failed) in counts.items()
    ])
    return df.agg(results.alias("r")).select(F.explode("r").alias("r")).select("r.*")


def q_duplicate_countries(df: DataFrame, keys=("country", "extraction_date"), table: str = "countries",
                          name: str = "duplicate_countries") -> DataFrame:
    """Groups of equal keys with more than one row."""
    return check_row(_count(dedup.duplicate_keys(df, list(keys))), table, name)


def _single(name: str):
    def check(df: DataFrame, as_of=None, table: str = "countries", **limits) -> DataFrame:
        return row_checks(df, row_check_tests(as_of, **limits), table, only=(name,))
    check.__name__ = f"q_{name}"
    check.__doc__ = f"The ``{name}`` row check on its own."
    return check


q_null_country_names = _single("null_country_names")
q_negative_cases = _single("negative_cases")
q_data_freshness = _single("data_freshness")
q_cases_consistency = _single("cases_consistency")
q_mortality_rate = _single("mortality_rate_check")
q_active_calculation = _single("active_cases_calculation")


def q_date_gaps(history: DataFrame, allowed: int = 100) -> DataFrame:
    """Gaps of more than one day in the series, without the global one."""
    return check_row(_count(series.date_gaps(history)), "historical", "date_gaps", allowed)


def q_large_negative_changes(history: DataFrame, limit: int = -10_000, metric: str = "cases",
                             allowed: int = 50) -> DataFrame:
    """Daily drops beyond ``limit`` (column ``daily_change``)."""
    hits = history.filter((F.col("daily_change") < limit) & (F.col("metric") == metric))
    return check_row(_count(hits), "historical", "large_negative_changes", allowed)


def major_completeness(countries: DataFrame, history: DataFrame, min_cases: int = 100_000,
                       metric: str = "cases") -> DataFrame:
    """Per major country: days with data and days in its span.

    Days are made distinct per country first, so the join sees one row per country.
    """
    major = countries.filter(F.col("cases") > min_cases).select("country").distinct()
    days = (
        history.filter(F.col("metric") == metric).select("country", "date").distinct()
        .groupBy("country").agg(
            F.count("date").alias("days_with_data"),
            (F.datediff(F.max("date"), F.min("date")) + 1).alias("expected_days"))
    )
    return days.join(major, "country", "left_semi")


def q_completeness_major(countries: DataFrame, history: DataFrame, min_cases: int = 100_000,
                         min_share: float = 0.9, allowed: int = 5) -> DataFrame:
    per_country = major_completeness(countries, history, min_cases)
    short = per_country.filter(F.col("days_with_data") / F.col("expected_days") < min_share)
    return check_row(_count(short), "historical", "completeness_major_countries", allowed)


def latest_metrics(history: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Per country: greatest cases and deaths of the last ``days`` days, newest date."""
    pick = lambda metric: F.max(F.when(F.col("metric") == metric, F.col("value")))
    recent = history.filter(F.col("date") >= F.date_sub(clean.clock(as_of).cast("date"), days))
    return recent.groupBy("country").agg(
        pick("cases").alias("hist_cases"), pick("deaths").alias("hist_deaths"), F.max("date").alias("latest_date"))


def historical_vs_current(countries: DataFrame, history: DataFrame, as_of, min_cases: int = 1000) -> DataFrame:
    """Current totals beside the latest series values, with absolute differences."""
    current = countries.filter(F.col("cases") > min_cases).select(
        "country", F.col("cases").alias("current_cases"), F.col("deaths").alias("current_deaths"))
    return joins.join_unique(current, latest_metrics(history, as_of), "country", "inner", hot=[]).withColumns({
        "cases_diff": F.abs(F.col("current_cases") - F.col("hist_cases")),
        "deaths_diff": F.abs(F.col("current_deaths") - F.col("hist_deaths")),
    })


def q_historical_vs_current(countries: DataFrame, history: DataFrame, as_of, min_cases: int = 1000,
                            tolerance: float = 0.1, allowed: int = 20) -> DataFrame:
    compared = historical_vs_current(countries, history, as_of, min_cases)
    off = (F.col("cases_diff") > F.col("current_cases") * tolerance) | (
        F.col("deaths_diff") > F.col("current_deaths") * tolerance)
    return check_row(_count(compared.filter(off)), "cross_table_consistency", "historical_vs_current", allowed)


def q_min_record_counts(tables: dict[str, DataFrame], minimum: dict[str, int] | None = None) -> DataFrame:
    """Row count of each table against its minimum."""
    minimum = S.MINIMUM_RECORDS if minimum is None else minimum
    return reduce(DataFrame.unionByName, [
        tables[name].agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("table_name"), "record_count", F.lit(low).alias("minimum_expected"),
            C.status(F.col("record_count") < low).alias("status"))
        for name, low in minimum.items() if name in tables
    ])


def q_recent_data(tables: dict[str, DataFrame], as_of, max_hours: float = 24) -> DataFrame:
    """Hours since the newest extraction of each table; no data fails."""
    hours = C.hours_between(clean.clock(as_of), F.col("latest_extraction"))
    return reduce(DataFrame.unionByName, [
        df.agg(F.max("extraction_date").alias("latest_extraction")).select(
            F.lit(name).alias("table_name"), "latest_extraction", hours.alias("hours_since_extraction"))
        for name, df in tables.items()
    ]).withColumn("status", F.when(F.col("hours_since_extraction") <= max_hours, "PASS").otherwise("FAIL"))


def q_summary(checks: DataFrame) -> DataFrame:
    """Totals, pass percentage and grade of any set of check rows."""
    row = checks.agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if(F.col("status") == "PASS").alias("passed_checks"),
        F.count_if(F.col("status") == "FAIL").alias("failed_checks"))
    failed = F.col("failed_checks")
    bands = [("EXCELLENT", failed == 0), ("GOOD", failed <= 2), ("FAIR", failed <= 5)]
    share = F.try_divide(F.col("passed_checks") * F.lit(100.0), F.col("total_checks"))
    return row.withColumn("pass_percentage", F.round(share, 2)).withColumn(
        "overall_quality", C.grade(failed, bands, "POOR"))


def _as_check(rows: DataFrame, name: str, count: Column) -> DataFrame:
    return rows.select("table_name", F.lit(name).alias("check_type"), count.cast("bigint").alias("count"), "status")


def all_checks(countries: DataFrame, history: DataFrame | None, as_of, min_records: int = 190,
               tables: dict[str, DataFrame] | None = None, history_limits: dict[str, dict] | None = None, **limits) -> DataFrame:
    """Every check of this module that the given tables allow, as one set of check rows.

    ``tables`` adds the minimum counts and the age (in hours) of each of them; ``history_limits`` has
    arguments for the history checks by function name, ``limits`` those of the row checks.
    """
    given = history_limits or {}
    parts = [
        row_checks(countries, row_check_tests(as_of, **limits), min_records=None if tables else min_records),
        q_duplicate_countries(countries),
    ]
    if history is not None:
        parts += [q_date_gaps(history, **given.get("q_date_gaps", {})),
                  q_completeness_major(countries, history, **given.get("q_completeness_major", {})),
                  q_historical_vs_current(countries, history, as_of, **given.get("q_historical_vs_current", {}))]
        if "daily_change" in history.columns:
            parts.append(q_large_negative_changes(history, **given.get("q_large_negative_changes", {})))
    if tables:
        parts += [_as_check(q_min_record_counts(tables), "minimum_record_count", F.col("record_count")),
                  _as_check(q_recent_data(tables, as_of), "recent_data", F.floor("hours_since_extraction"))]
    return reduce(DataFrame.unionByName, parts)
