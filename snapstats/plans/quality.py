"""Validation of data sets: checks, profile, outliers, score and reports.

All counting checks of a data set share one aggregation pass; duplicates and
outlier bounds need one more each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapstats import schemas as S
from snapstats.functions import columns as C
from snapstats.operators import clean, dedup, quantiles

# Thresholds and score weights.
MAX_NULL_SHARE = 0.1
MIN_RECORDS = 100
ERROR_POINTS, WARNING_POINTS, NULL_POINTS, DUPLICATE_POINTS = 20, 5, 50, 30
DUPLICATE_SHARE_LIMIT = 0.05
IQR_FACTOR = 1.5
ACTIVE_TOLERANCE = 0.01
MAX_DEATH_RATE = 0.1

CHECK_FIELDS = ("check_name", "severity", "observed", "threshold", "status", "detail")


def _check(name: str, severity: str, observed: Column, threshold: Column, failed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        observed.cast("double").alias("observed"), threshold.cast("double").alias("threshold"),
        C.status(failed).alias("status"), detail.alias("detail"))


def _counted(name: str, severity: str, count: Column, what: str, names: Column | None = None) -> Column:
    """Check that fails when a count is above zero; ``names`` tells what was counted."""
    detail = F.concat(F.lit("found "), count.cast("string"), F.lit(f" {what}"))
    if names is not None:
        detail = F.concat_ws(": ", detail, names)
    return _check(name, severity, count, F.lit(0), count > 0, detail)


def null_counts(df: DataFrame) -> dict[str, Column]:
    """Aggregates: missing values per column (NaN counts as missing)."""
    return {f.name: F.count_if(C.is_missing(f"`{f.name}`", f.dataType)) for f in df.schema.fields}


def null_profile(df: DataFrame, max_share: float = MAX_NULL_SHARE) -> DataFrame:
    """Per column: missing values, their share, whether it is above the limit. One pass."""
    counts = null_counts(df)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.array(*[
        F.struct(F.lit(c).alias("column_name"), n.alias("null_count")) for c, n in counts.items()
    ]).alias("cols"))
    share = F.coalesce(F.try_divide(F.col("null_count"), F.col("n")), F.lit(0.0))
    return (
        row.select("n", F.explode("cols").alias("c")).select("n", "c.*")
        .select("column_name", "null_count", share.alias("null_percentage"))
        .withColumn("is_high", F.col("null_percentage") > max_share)
    )


def type_profile(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def estimated_bytes(df: DataFrame) -> Column:
    """Aggregate: 8 bytes per scalar, the encoded length per text, JSON length if nested."""
    width = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType)):
            width = width + F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))
        else:
            width = width + F.lit(8)
    return F.coalesce(F.sum(width.cast("bigint")), F.lit(0))


def iqr_outliers(df: DataFrame, columns=None, exact: bool = True) -> DataFrame:
    """Outliers per numeric column by the interquartile rule; share over all rows.

    The quartiles enter the counting pass as literals, so rows are only counted.
    """
    columns = list(columns or C.numeric_columns(df.schema))
    quartiles = quantiles.quantiles(df, columns, (0.25, 0.75), exact=exact)
    parts = []
    for c in columns:
        low_q, high_q = quartiles[c]
        if low_q is None:
            low = high = F.lit(None).cast("double")
            outside = F.lit(0).cast("bigint")
        else:
            spread = IQR_FACTOR * (high_q - low_q)
            low, high = F.lit(low_q - spread), F.lit(high_q + spread)
            present = ~C.is_missing(f"`{c}`", df.schema[c].dataType)
            outside = F.count_if(present & ((F.col(f"`{c}`") < low) | (F.col(f"`{c}`") > high)))
        parts.append(F.struct(
            F.lit(c).alias("column_name"), outside.alias("outlier_count"),
            F.coalesce(F.try_divide(outside, F.count(F.lit(1))), F.lit(0.0)).alias("outlier_percentage"),
            low.alias("lower_bound"), high.alias("upper_bound")))
    return df.agg(F.array(*parts).alias("o")).select(F.explode("o").alias("o")).select("o.*")


# --- checks -----------------------------------------------------------------


def _measures(df: DataFrame, dataset: str) -> dict[str, Column]:
    """Aggregates behind the data set's own checks."""
    have = set(df.columns)
    out: dict[str, Column] = {}
    if dataset == "global":
        for c in ("cases", "deaths", "recovered"):
            if c in have and C.is_number(df.schema[c].dataType):
                out[f"negative_{c}"] = F.count_if(F.col(c) < 0)
    if dataset == "countries" and "country" in have:
        out["null_country"] = F.count_if(F.col("country").isNull())
    for c, length in S.CODE_LENGTHS.get(dataset, {}).items():
        if c in have:
            out[f"length_{c}"] = F.count_if(F.length(c) != length)
    if dataset == "historical":
        if "date" in have:
            day = _as_day(df, "date")
            out["bad_date"] = F.count_if(F.col("date").isNotNull() & day.isNull())
            out["first_day"], out["last_day"] = F.min(day), F.max(day)
        if "metric" in have:
            out["unknown_metric"] = F.count_if(F.col("metric").isNull() | ~F.col("metric").isin(list(S.METRICS)))
    return out


def _as_day(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        c = clean.to_timestamp_lenient(c, S.SERIES_DATE_FORMAT)
    return c.cast("date")


def unknown_values(df: DataFrame, column: str, allowed) -> DataFrame:
    """The values outside ``allowed``, with counts (a table, as they may be many)."""
    return df.filter(F.col(column).isNull() | ~F.col(column).isin(list(allowed))).groupBy(column).count()


def _named_values(df: DataFrame, column: str, allowed) -> Column:
    """All values outside ``allowed`` as text, each with its rows, the most frequent first."""
    named = F.concat(F.coalesce(F.col(column).cast("string"), F.lit("null")), F.lit(" ("), F.col("count").cast("string"), F.lit(")"))
    return unknown_values(df, column, allowed).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        (-F.col("count")).alias("n"), F.col(column).alias("value"), named.alias("name")))), lambda x: x["name"]), ", ")).scalar()


def _profile(df: DataFrame, dataset: str) -> DataFrame:
    """One row with every measure of the data set."""
    nulls = F.map_from_arrays(
        F.array(*[F.lit(c) for c in df.columns]), F.array(*null_counts(df).values()))
    duplicates = dedup.duplicate_stats(df).select("duplicate_count").scalar()
    row = df.agg(F.count(F.lit(1)).alias("record_count"), nulls.alias("null_counts"),
                 estimated_bytes(df).alias("bytes"),
                 *[m.alias(f"m_{k}") for k, m in _measures(df, dataset).items()])
    row = row.withColumn("duplicate_count", duplicates)
    if "unknown_metric" in _measures(df, dataset):
        row = row.withColumn("unknown_names", _named_values(df, "metric", S.METRICS))
    if dataset == "countries" and "country" in df.columns:
        row = row.withColumn(
            "duplicate_countries", dedup.duplicate_stats(df, ["country"]).select("duplicate_count").scalar())
    share = lambda k, n: F.coalesce(F.try_divide(n, F.col("record_count")), F.lit(0.0))
    return row.withColumns({
        "duplicate_percentage": F.coalesce(F.try_divide("duplicate_count", "record_count"), F.lit(0.0)),
        "null_percentages": F.transform_values("null_counts", share),
    })


def _checks(df: DataFrame, dataset: str, as_of, min_records: int, max_null_share: float) -> list[Column]:
    """Check structs over the profile row."""
    have, measures = set(df.columns), _measures(df, dataset)
    n = F.col("record_count")
    high = F.size(F.map_filter("null_percentages", lambda k, share: share > max_null_share))
    out = [
        _check("empty", "error", n, F.lit(1), n == 0, F.lit("no rows")),
        _check("min_rows", "warning", n, F.lit(min_records), (n > 0) & (n < min_records),
               F.concat(n.cast("string"), F.lit(f" rows, expected {min_records}"))),
        _counted("duplicate_rows", "warning", F.col("duplicate_count"), "duplicate rows"),
        _check("null_share", "warning", high, F.lit(max_null_share), high > 0,
               F.concat(high.cast("string"), F.lit(f" columns above {max_null_share} missing"))),
    ]
    required = S.REQUIRED_COLUMNS.get(dataset, ())
    missing = [c for c in required if c not in have]
    if required:
        out.append(_check("required_columns", "error", F.lit(len(missing)), F.lit(0), F.lit(bool(missing)),
                          F.lit(f"missing: {', '.join(missing)}")))
    for c in S.NUMERIC_COLUMNS.get(dataset, ()):
        if c in have:
            bad = not C.is_number(df.schema[c].dataType)
            out.append(_check(f"numeric_{c}", "error", F.lit(int(bad)), F.lit(0), F.lit(bad), F.lit(f"{c} is not numeric")))
    texts = {
        "null_country": ("error", "rows without country"),
        "bad_date": ("error", "dates that cannot be read"),
        "unknown_metric": ("warning", "rows with an unknown metric"),
    }
    for key in measures:
        if key in ("first_day", "last_day"):
            continue
        severity, what = texts.get(key, ("warning", key.replace("_", " ")))
        out.append(_counted(key, severity, F.col(f"m_{key}"), what, F.col("unknown_names") if key == "unknown_metric" else None))
    if dataset == "countries" and "country" in have:
        out.append(_counted("duplicate_countries", "warning", F.col("duplicate_countries"), "duplicate countries"))
    if "first_day" in measures:
        earliest = F.lit(S.FIRST_VALID_DATE).cast("date")
        latest = (clean.clock(as_of) + F.expr("INTERVAL 1 DAY"))
        first, last = F.col("m_first_day"), F.col("m_last_day")
        out.append(_check("first_date", "warning", F.unix_date(first), F.unix_date(earliest), first < earliest,
                          F.concat(F.lit("first date "), first.cast("string"))))
        out.append(_check("last_date", "warning", F.unix_date(last), F.unix_date(latest.cast("date")),
                          last.cast("timestamp") > latest, F.concat(F.lit("last date "), last.cast("string"))))
    return out


def check_results(df: DataFrame, dataset: str, as_of=None, min_records: int = MIN_RECORDS,
                  max_null_share: float = MAX_NULL_SHARE) -> DataFrame:
    """One row per check: dataset, name, severity, observed, threshold, status, detail."""
    checks = F.array(*_checks(df, dataset, as_of, min_records, max_null_share))
    return _profile(df, dataset).select(F.explode(checks).alias("c")).select(F.lit(dataset).alias("dataset"), "c.*")


def quality_score(errors: Column, warnings: Column, null_percentages: Column, duplicate_share: Column,
                  max_null_share: float = MAX_NULL_SHARE) -> Column:
    """Score from 0 to 100: points off per error, warning, missing share and duplicates."""
    nulls = F.aggregate(
        F.map_values(null_percentages), F.lit(0.0),
        lambda total, share: total + F.greatest(share - F.lit(max_null_share), F.lit(0.0)) * F.lit(float(NULL_POINTS)))
    duplicates = F.when(duplicate_share > DUPLICATE_SHARE_LIMIT, duplicate_share * DUPLICATE_POINTS).otherwise(F.lit(0.0))
    raw = F.lit(100.0) - errors * ERROR_POINTS - warnings * WARNING_POINTS - nulls - duplicates
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw))


def validate(df: DataFrame, dataset: str, as_of=None, min_records: int = MIN_RECORDS,
             max_null_share: float = MAX_NULL_SHARE) -> DataFrame:
    """Whole validation of a data set as one row."""
    checks = F.array(*_checks(df, dataset, as_of, min_records, max_null_share))
    row = _profile(df, dataset).withColumn("checks", checks)
    failed = lambda severity: F.transform(
        F.filter("checks", lambda c: (c["status"] == "FAIL") & (c["severity"] == severity)),
        lambda c: F.concat_ws(": ", c["check_name"], c["detail"]))
    row = row.withColumns({"errors": failed("error"), "warnings": failed("warning")})
    return row.select(
        F.lit(dataset).alias("dataset"), clean.clock(as_of).alias("validation_timestamp"),
        "record_count", F.lit(len(df.columns)).alias("column_count"),
        (F.size("errors") == 0).alias("is_valid"), "errors", "warnings",
        "null_percentages", "duplicate_percentage",
        F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair]).alias("data_types"),
        (F.col("bytes") / (1024 * 1024)).alias("estimated_mb"),
        quality_score(F.size("errors"), F.size("warnings"), F.col("null_percentages"),
                      F.col("duplicate_percentage"), max_null_share).alias("quality_score"))


VALIDATION_SCHEMA = (
    "dataset STRING, validation_timestamp TIMESTAMP, record_count BIGINT, column_count INT, is_valid BOOLEAN, "
    "errors ARRAY<STRING>, warnings ARRAY<STRING>, null_percentages MAP<STRING, DOUBLE>, duplicate_percentage DOUBLE, "
    "data_types MAP<STRING, STRING>, estimated_mb DOUBLE, quality_score DOUBLE"
)


def validated(df: DataFrame, dataset: str, as_of=None, **limits) -> DataFrame:
    """The row of ``validate``, computed now; if that fails, a row that says so, with score 0."""
    spark = df.sparkSession
    try:
        row = [tuple(r) for r in validate(df, dataset, as_of, **limits).collect()]      # one row
    except Exception as problem:
        reason = (str(problem).splitlines() or [type(problem).__name__])[0]
        failed = spark.range(1).select(
            F.lit(dataset).alias("dataset"), clean.clock(as_of).alias("validation_timestamp"), F.lit(None).cast("bigint").alias("record_count"),
            F.lit(len(df.columns)).alias("column_count"), F.lit(False).alias("is_valid"),
            F.array(F.lit(f"validation failed: {reason}")).alias("errors"))
        for field in T.StructType.fromDDL(VALIDATION_SCHEMA).fields[6:]:
            failed = failed.withColumn(field.name, F.lit(None).cast(field.dataType))
        return failed.withColumn("warnings", F.array().cast("array<string>")).withColumn("quality_score", F.lit(0.0))
    return spark.createDataFrame(row, VALIDATION_SCHEMA)


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Column profile: type, missing values and, for numbers, outlier counts and bounds."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    nulls = null_profile(df).withColumn("data_type", F.try_element_at(types, F.col("column_name")))
    return nulls.join(iqr_outliers(df, exact=exact), "column_name", "left")


# --- business rules -----------------------------------------------------------


def rule_violations(df: DataFrame, dataset: str, tolerance: float = ACTIVE_TOLERANCE,
                    max_death_rate: float = MAX_DEATH_RATE) -> DataFrame:
    """Rows breaking each rule that the columns allow to test (global and countries)."""
    have = set(df.columns)
    rules: dict[str, Column] = {}
    if dataset in ("global", "countries"):
        number = lambda c: F.col(c) if c not in have or C.is_number(df.schema[c].dataType) else F.col(c).try_cast("double")
        cases, deaths, recovered, active = map(number, ("cases", "deaths", "recovered", "active"))
        if {"cases", "deaths", "recovered"} <= have:
            rules["cases_below_outcomes"] = cases < deaths + recovered
            if "active" in have:
                rules["active_mismatch"] = C.off_by_more_than(active, cases - deaths - recovered, cases * tolerance)
        if {"cases", "deaths"} <= have:
            # A positive count over zero cases is an infinite rate; zero over zero is no rate.
            rules["high_death_rate"] = F.when(cases == 0, deaths > 0).otherwise(
                F.try_divide(deaths, cases) > max_death_rate)
    if not rules:
        return df.sparkSession.createDataFrame([], "rule STRING, violations BIGINT")
    counted = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.count_if(test).alias("violations")) for name, test in rules.items()
    ])
    return df.agg(counted.alias("r")).select(F.explode("r").alias("r")).select("r.*")


# --- bundles -------------------------------------------------------------------


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def validation_report(results: DataFrame) -> DataFrame:
    """Report rows: one per data set, preceded by a total row."""
    line = results.select(
        F.lit("dataset").alias("level"), "dataset", "record_count", "column_count",
        F.col("is_valid").cast("int").cast("bigint").alias("valid_datasets"),
        (~F.col("is_valid")).cast("int").cast("bigint").alias("invalid_datasets"),
        "quality_score", F.array_join("errors", "; ").alias("errors"), F.array_join("warnings", "; ").alias("warnings"))
    total = results.agg(
        F.lit("total").alias("level"), F.lit(None).cast("string").alias("dataset"),
        F.sum("record_count").alias("record_count"), F.lit(None).cast("int").alias("column_count"),
        F.count_if("is_valid").alias("valid_datasets"), F.count_if(~F.col("is_valid")).alias("invalid_datasets"),
        F.avg("quality_score").alias("quality_score"),
        F.lit(None).cast("string").alias("errors"), F.lit(None).cast("string").alias("warnings"))
    return total.unionByName(line)


def bundle_summary(bundle: dict[str, DataFrame]) -> DataFrame:
    """Per data set: rows, columns, estimated size, emptiness."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("record_count"), estimated_bytes(df).alias("bytes")).select(
            F.lit(name).alias("dataset"), "record_count", F.lit(len(df.columns)).alias("column_count"),
            F.array(*map(F.lit, df.columns)).alias("columns"),
            (F.col("bytes") / (1024 * 1024)).alias("estimated_mb"), (F.col("record_count") == 0).alias("is_empty"))
        for name, df in bundle.items()
    ])


def gate_extraction(summary: DataFrame | None, min_records: int = 10) -> DataFrame:
    """Gate after extraction: an empty bundle raises, small data sets warn."""
    if summary is None:
        raise ValueError("no data sets were extracted")
    return summary.select("dataset", "record_count", F.when(
        F.col("is_empty"), F.lit("EMPTY")).when(F.col("record_count") < min_records, F.lit("FEW")).otherwise(
        F.lit("OK")).alias("gate"))


def _missing_cells(df: DataFrame) -> Column:
    return reduce(lambda a, b: a + b, null_counts(df).values())


def file_quality(bundle: dict[str, DataFrame]) -> DataFrame:
    """Per data set: rows, columns, missing cells and which pipeline columns it holds."""
    return _union([
        df.agg(F.count(F.lit(1)).alias("record_count"), _missing_cells(df).alias("missing_values")).select(
            F.lit(name).alias("dataset"), "record_count", F.lit(len(df.columns)).alias("column_count"),
            "missing_values", *[F.lit(c in df.columns).alias(f"has_{c}")
                                for c in ("extraction_date", "processed_at", "mortality_rate")])
        for name, df in bundle.items()
    ])


# Grade limits (percent complete).
GRADE_LIMITS = (("Excellent", 95), ("Good", 90))


def completeness_grade(bundle: dict[str, DataFrame]) -> DataFrame:
    """Percent of cells present and its grade per data set, plus a total row."""
    cells = file_quality(bundle).select(
        "dataset", "record_count", "column_count", "missing_values",
        (F.col("record_count") * F.col("column_count")).alias("cells"))
    total = cells.agg(
        F.lit("TOTAL").alias("dataset"), F.sum("record_count").alias("record_count"),
        F.lit(None).cast("int").alias("column_count"), F.sum("missing_values").alias("missing_values"),
        F.sum("cells").alias("cells"))
    percent = F.coalesce(
        (F.lit(1.0) - F.try_divide(F.col("missing_values"), F.col("cells"))) * F.lit(100.0), F.lit(0.0))
    graded = cells.unionByName(total).withColumn("completeness", percent)
    bands = [(name, F.col("completeness") > limit) for name, limit in GRADE_LIMITS]
    return graded.withColumn("grade", C.grade(F.col("completeness"), bands, "Poor")).drop("cells")
