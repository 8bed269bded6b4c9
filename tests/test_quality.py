import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapstats.plans import checks, completeness, quality, reports

NOW = "2024-05-01 12:00:00"


def by_name(df):
    return {r["check_name"]: r for r in df.collect()}


def test_empty_frame_is_invalid(spark):
    df = spark.createDataFrame([], "country STRING, cases BIGINT, deaths BIGINT")
    row = quality.validate(df, "countries", NOW).first()
    assert row["is_valid"] is False and row["record_count"] == 0 and row["quality_score"] == 80.0
    assert row["errors"] == ["empty: no rows"]


def test_required_and_numeric_columns(spark):
    df = spark.createDataFrame([("5", -1)], "cases STRING, deaths BIGINT")
    got = by_name(quality.check_results(df, "global", NOW))
    assert got["required_columns"]["status"] == "FAIL" and got["required_columns"]["detail"] == "missing: recovered, active"
    assert got["numeric_cases"]["status"] == "FAIL" and got["numeric_deaths"]["status"] == "PASS"
    assert got["negative_deaths"]["status"] == "FAIL" and got["min_rows"]["status"] == "FAIL"


def test_countries_checks(spark):
    df = spark.createDataFrame([("A", "AA", "AAA"), ("A", "A", None), (None, None, "AAAA"), (None, "BB", "BBB")],
                               "country STRING, country_iso2 STRING, country_iso3 STRING")
    got = by_name(quality.check_results(df, "countries", NOW))
    assert got["null_country"]["observed"] == 2 and got["null_country"]["severity"] == "error"
    assert got["duplicate_countries"]["observed"] == 2
    assert got["length_country_iso2"]["observed"] == 1 and got["length_country_iso3"]["observed"] == 1


def test_history_checks(spark):
    df = spark.createDataFrame(
        [("11/30/19", "cases", 1, "A"), ("oops", "boosters", 1, "A"), ("2024-05-03", None, 1, "A")],
        "date STRING, metric STRING, value BIGINT, country STRING")
    got = by_name(quality.check_results(df, "historical", NOW))
    assert got["bad_date"]["observed"] == 1 and got["unknown_metric"]["observed"] == 2
    assert got["first_date"]["status"] == "FAIL" and got["last_date"]["status"] == "FAIL"
    assert {r["metric"] for r in quality.unknown_values(df, "metric", ("cases",)).collect()} == {"boosters", None}


def test_score_arithmetic(spark):
    rows = [(i if i % 2 else None, 1) for i in range(200)] + [(1, 1)] * 50
    df = spark.createDataFrame(rows, "a BIGINT, b BIGINT")
    row = quality.validate(df, "states", NOW).first()
    # 100 null shares of 250; duplicates: 99 repeated nulls and 50 repeats of (1, 1).
    nulls, duplicates = 100 / 250, (99 + 50) / 250
    assert len(row["warnings"]) == 2 and row["is_valid"]
    assert row["quality_score"] == pytest.approx(100 - 10 - (nulls - 0.1) * 50 - duplicates * 30)
    assert row["null_percentages"] == {"a": pytest.approx(0.4), "b": 0.0}


def test_score_is_clamped(spark):
    df = spark.createDataFrame([(None, None, None, None)] * 3, "a STRING, b STRING, c STRING, cases STRING")
    assert quality.validate(df, "global", NOW).first()["quality_score"] == 0.0


def test_outliers_ignore_nulls_but_share_counts_rows(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)] * 5, "x DOUBLE")
    row = quality.iqr_outliers(df).first()
    assert (row["outlier_count"], row["outlier_percentage"], row["lower_bound"], row["upper_bound"]) == (1, 0.1, -1.0, 7.0)


def test_rules_on_zero_cases(spark):
    df = spark.createDataFrame([(0, 5, 0, 0), (0, 0, 0, 0), (100, 11, 0, 89), (100, 5, 90, 80), (10, 8, 8, -6)],
                               "cases BIGINT, deaths BIGINT, recovered BIGINT, active BIGINT")
    got = {r["rule"]: r["violations"] for r in quality.rule_violations(df, "countries").collect()}
    assert got == {"cases_below_outcomes": 2, "active_mismatch": 2, "high_death_rate": 3}
    assert quality.rule_violations(df, "states").isEmpty()


def test_bundle_reports(spark):
    bundle = {"a": spark.createDataFrame([("x", None)] * 12, "s STRING, n INT"), "b": spark.createDataFrame([], "s STRING")}
    summary = {r["dataset"]: r for r in quality.bundle_summary(bundle).collect()}
    assert summary["a"]["record_count"] == 12 and summary["b"]["is_empty"] and summary["a"]["columns"] == ["s", "n"]
    gates = {r["dataset"]: r["gate"] for r in quality.gate_extraction(quality.bundle_summary(bundle)).collect()}
    assert gates == {"a": "OK", "b": "EMPTY"}
    grades = {r["dataset"]: (r["completeness"], r["grade"]) for r in quality.completeness_grade(bundle).collect()}
    assert grades == {"a": (50.0, "Poor"), "b": (0.0, "Poor"), "TOTAL": (50.0, "Poor")}
    with pytest.raises(ValueError):
        quality.gate_extraction(None)


def test_row_checks_read_the_table_once(spark, small):
    df = spark.read.parquet(f"{small}/customer.parquet").select(
        F.col("c_name").alias("country"), *[F.col("c_custkey").alias(c) for c in ("cases", "deaths", "recovered", "active")],
        F.col("c_acctbal").alias("mortality_rate"), F.lit(NOW).cast("timestamp").alias("updated"))
    out = checks.row_checks(df, checks.row_check_tests(NOW))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert out.count() == 6


def test_checks_with_nulls(spark):
    df = spark.createDataFrame([(None, None, -1, 1, 1, None, None)],
                               "country STRING, cases BIGINT, deaths BIGINT, recovered BIGINT, active BIGINT, mortality_rate DOUBLE, updated TIMESTAMP")
    got = {r["check_type"]: r["count"] for r in checks.row_checks(df, checks.row_check_tests(NOW)).collect()}
    assert got == {"null_country_names": 1, "negative_cases": 1, "data_freshness": 0, "cases_consistency": 0,
                   "mortality_rate_check": 0, "active_cases_calculation": 0}


def test_summary_grades(spark):
    for failed, grade in ((0, "EXCELLENT"), (2, "GOOD"), (5, "FAIR"), (6, "POOR")):
        df = spark.createDataFrame([("FAIL",)] * failed + [("PASS",)] * 3, "status STRING")
        assert checks.q_summary(df).first()["overall_quality"] == grade


def test_recent_data_without_rows_fails(spark):
    none = spark.createDataFrame([], "extraction_date TIMESTAMP")
    assert checks.q_recent_data({"t": none}, NOW).first()["status"] == "FAIL"


def test_calendar_identity(spark):
    days = [dt.date(2024, 2, 26) + dt.timedelta(days=i) for i in (0, 1, 4, 4, 9)]
    df = spark.createDataFrame([(d,) for d in days], "date DATE")
    missing = completeness.missing_dates(df).count()
    assert missing == 10 - len(set(days))
    assert completeness.m_missing_dates(df, allowed=5).first()["status"] == "FAIL"
    assert completeness.missing_dates(df.limit(0)).count() == 0


def test_expected_members_are_arguments(spark):
    df = spark.createDataFrame([("Asia",), ("Australia-Oceania",), (None,)], "continent STRING")
    got = completeness.m_missing_continents(df).first()
    assert (got["count"], got["status"]) == (5, "FAIL")
    assert completeness.m_missing_continents(df, ("Asia", "Australia-Oceania")).first()["status"] == "PASS"


def test_scores_of_empty_history(spark):
    countries = spark.createDataFrame([("A", 1, None, 0)], "country STRING, cases BIGINT, deaths BIGINT, population BIGINT")
    history = spark.createDataFrame([], "date DATE, metric STRING, value BIGINT, country STRING")
    rows = {r["data_type"]: r for r in completeness.m_scores(countries, history, NOW).collect()}
    assert rows["countries"]["avg_completeness"] == 50.0 and rows["countries"]["completeness_grade"] == "POOR"
    assert rows["historical"]["avg_completeness"] is None


def test_shares_sum_to_hundred(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 4)], "continent STRING, cases BIGINT")
    shares = [r["share_pct"] for r in reports.share_of_total(df).collect()]
    assert sum(shares) == pytest.approx(100) and shares == sorted(shares, reverse=True)


def test_top_n_is_taken_without_a_full_sort(spark):
    df = spark.createDataFrame([("a", 1, 0, None), ("b", 9, 1, 0.1), ("c", 9, 1, 0.2)], "country STRING, cases BIGINT, deaths BIGINT, mortality_rate DOUBLE")
    out = reports.top_n(df, "country", 2)
    assert [(r["country"], r["mortality_pct"]) for r in out.collect()] == [("b", 10.0), ("c", 20.0)]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()
    assert [r["country"] for r in reports.top_mortality(df, "country", 1, min_cases=5).collect()] == ["c"]


def test_every_unknown_metric_is_named(spark):
    rows = [("2024-05-03", f"m{k:02}", 1, "A") for k in range(25) for _ in range(1 + k // 20)] + [("2024-05-03", "cases", 1, "A")]
    df = spark.createDataFrame(rows, "date STRING, metric STRING, value BIGINT, country STRING")
    warning, = [w for w in quality.validate(df, "historical", NOW).first()["warnings"] if w.startswith("unknown_metric")]
    names = [f"m{k} (2)" for k in range(20, 25)] + [f"m{k:02} (1)" for k in range(20)]
    assert warning == "unknown_metric: found 30 rows with an unknown metric: " + ", ".join(names)
