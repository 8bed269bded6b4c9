"""Cleaning and derivation steps. Each takes and returns a DataFrame.

Which columns a step touches is decided from ``df.schema`` while the plan is
built. Only ``fill_rates_with_median`` runs jobs of its own, to find the medians.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from snapstats import schemas as S
from snapstats.functions import columns as C
from snapstats.operators import joins, quantiles


def clock(as_of: dt.datetime | str | Column | None) -> Column:
    """The run's clock as a timestamp column; the current time if none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def with_lineage(df: DataFrame, as_of, source: str, data_type: str) -> DataFrame:
    return df.withColumns({
        "extraction_date": clock(as_of),
        "data_source": F.lit(source),
        "data_type": F.lit(data_type),
    })


def epoch_ms_to_ts(df: DataFrame, column: str = "updated") -> DataFrame:
    """Epoch milliseconds to timestamp; no-op if the column is absent or already a time."""
    if column not in df.columns:
        return df
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df
    return df.withColumn(column, C.epoch_ms(column))


def flatten_struct(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Replace a struct column by one ``prefix + field`` column per field."""
    if column not in df.columns:
        return df
    fields = df.schema[column].dataType.fieldNames()
    kept = [F.col(f"`{c}`") for c in df.columns if c != column]
    return df.select(*kept, *[F.col(f"`{column}`.`{f}`").alias(prefix + f) for f in fields])


def standard_name(name: str) -> str:
    """Lower case, other characters to ``_``, single ``_``, none at the ends."""
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9]", "_", name.lower())).strip("_")


def standardize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[standard_name(c) for c in df.columns])


def fill_counts(df: DataFrame) -> DataFrame:
    """Missing numbers in count-like columns become 0."""
    names = C.numeric_columns(df.schema, S.COUNT_WORDS)
    return df.fillna(0, subset=names) if names else df


def fill_rates_with_median(df: DataFrame, exact: bool = True) -> DataFrame:
    """Missing numbers in rate-like columns become the column's median.

    Columns that cannot be null any more (already filled counts) are skipped. The
    medians come to the driver, one number per column, and enter the plan as
    literals, so filling itself needs neither join nor shuffle.
    """
    names = [c for c in C.numeric_columns(df.schema, S.RATE_WORDS) if df.schema[c].nullable]
    medians = quantiles.quantiles(df, names, (0.5,), exact=exact)
    changed = {}
    for name in names:
        median = medians[name][0]
        if median is None:
            continue
        missing = C.is_missing(name, df.schema[name].dataType)
        changed[name] = F.when(missing, F.lit(median)).otherwise(F.col(f"`{name}`"))
    return df.withColumns(changed)


def fill_strings(df: DataFrame) -> DataFrame:
    """Missing text: 'Unknown' for place names, 'N/A' elsewhere."""
    names = C.string_columns(df.schema)
    return df.fillna({
        c: "Unknown" if C.has_word(c, S.PLACE_WORDS) else "N/A" for c in names
    }) if names else df


def to_timestamp_lenient(column: Column | str, *formats: str) -> Column:
    """Text to timestamp by ISO rules, then by each format; null if none fits."""
    c = C.as_col(column)
    return F.coalesce(F.try_to_timestamp(c), *[F.try_to_timestamp(c, F.lit(f)) for f in formats])


def coerce_timestamps(df: DataFrame) -> DataFrame:
    """Time-like columns: text is parsed, numbers are epoch milliseconds."""
    changed = {}
    for field in df.schema.fields:
        if not C.has_word(field.name, S.TIME_WORDS):
            continue
        if isinstance(field.dataType, T.StringType):
            changed[field.name] = to_timestamp_lenient(f"`{field.name}`", S.SERIES_DATE_FORMAT)
        elif C.is_number(field.dataType):
            changed[field.name] = C.epoch_ms(f"`{field.name}`")
    return df.withColumns(changed)


def coerce_numerics(df: DataFrame, kind: str = "double") -> DataFrame:
    """Text in number-like columns becomes a number; bad text gives null."""
    names = C.string_columns(df.schema, S.NUMBER_WORDS)
    return df.withColumns({c: F.trim(F.col(f"`{c}`")).try_cast(kind) for c in names})


def clean_numeric(df: DataFrame, columns=("cases", "deaths", "recovered", "active", "critical")) -> DataFrame:
    """Listed columns to number, bad or missing values to 0."""
    changed = {}
    for name in columns:
        if name not in df.columns:
            continue
        kind = df.schema[name].dataType
        number = F.col(name) if C.is_number(kind) else F.trim(F.col(name)).try_cast("double")
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            number = F.nanvl(number, F.lit(None).cast(kind))
        changed[name] = F.coalesce(number, F.lit(0))
    return df.withColumns(changed)


def with_freshness(df: DataFrame, as_of=None) -> DataFrame:
    """Processing time and hours since ``updated`` (null without that column)."""
    now = clock(as_of)
    hours = C.hours_between(now, F.col("updated")) if "updated" in df.columns else F.lit(None).cast("double")
    return df.withColumns({"processed_at": now, "data_freshness_hours": hours})


def with_rates(df: DataFrame, dataset: str = "countries", zero: str = "guard") -> DataFrame:
    """Mortality, recovery and active rates and counts per million.

    ``zero='guard'``: 0 where the divisor is not positive. ``zero='one'``: zero
    cases count as one, and only mortality and recovery are derived. Data sets
    that hold no case counts pass through.
    """
    if dataset not in S.SNAPSHOT_DATASETS:
        return df
    have = set(df.columns)
    rates = {"mortality_rate": "deaths", "recovery_rate": "recovered"}
    divide = C.ratio_zero_as_one
    if zero == "guard":
        rates["active_rate"] = "active"
        divide = C.ratio
    out = {
        name: divide(source, "cases")
        for name, source in rates.items() if {source, "cases"} <= have
    }
    if zero == "guard" and "population" in have:
        for source in ("cases", "deaths"):
            if source in have:
                out[f"{source}_per_million"] = C.ratio(source, "population", C.MILLION)
    return df.withColumns(out)


def with_per_100k(df: DataFrame) -> DataFrame:
    """Cases, deaths and tests per 100 000 people; null where the population is 0."""
    if "population" not in df.columns:
        return df
    return df.withColumns({
        f"{c}_per_100k": C.per_head(c, "population", 100_000)
        for c in ("cases", "deaths", "tests") if c in df.columns
    })


# Region type and the column (or constant) naming the region.
_REGIONS = {
    "global": ("global", None, "World"),
    "countries": ("country", "country", None),
    "continents": ("continent", "continent", None),
    "states": ("state", "state", None),
}


def with_region(df: DataFrame, dataset: str) -> DataFrame:
    """Region tags of snapshots; the category tag of vaccination data."""
    if dataset == "vaccines":
        return df.withColumn("data_category", F.lit("vaccination"))
    if dataset not in _REGIONS:
        return df
    kind, column, constant = _REGIONS[dataset]
    out = {"region_type": F.lit(kind)}
    if constant is not None:
        out["region_name"] = F.lit(constant)
    elif column in df.columns:
        out["region_name"] = F.col(column)
    if dataset == "states":
        out["country"] = F.lit("USA")
    return df.withColumns(out)


def ensure_columns(df: DataFrame, columns, value=0) -> DataFrame:
    """Add absent columns with a constant."""
    return df.withColumns({c: F.lit(value) for c in columns if c not in df.columns})


def map_values(df: DataFrame, column: str, mapping: dict | DataFrame) -> DataFrame:
    """Replace exact matches in ``column``.

    A dict becomes a literal map. A two-column DataFrame (from, to) is joined, with
    frequent values spread over several tasks; a value with two targets is an error.
    """
    if isinstance(mapping, dict):
        return df.withColumn(column, C.mapped(column, mapping))
    old, new = mapping.columns
    target = F.when(F.min(new).eqNullSafe(F.max(new)), F.min(new)).otherwise(
        F.raise_error(F.concat(F.lit("two targets for "), F.first(old).cast("string"))))
    table = mapping.groupBy(F.col(old).alias(column)).agg(target.alias("__to"))
    joined = joins.join_unique(df, table, column)
    return joined.withColumn(column, F.coalesce("__to", column)).select(*df.columns)


def standardize_places(df: DataFrame, column: str = "country", mapping: dict | None = None) -> DataFrame:
    """Map name variants, then trim and title-case (mapped names are re-cased too)."""
    if column not in df.columns:
        return df
    renamed = map_values(df, column, S.COUNTRY_NAMES if mapping is None else mapping)
    return renamed.withColumn(column, C.title_case(column))


def drop_invalid(df: DataFrame, column: str, bad=S.INVALID_NAMES, ignore_case: bool = True) -> DataFrame:
    """Drop rows whose text is one of ``bad``; nulls stay."""
    if column not in df.columns:
        return df
    c = F.col(column)
    hit = F.lower(c).isin([b.lower() for b in bad]) if ignore_case else c.isin(list(bad))
    return df.filter(c.isNull() | ~hit)


def clip_lower(df: DataFrame, columns=("cases", "deaths", "recovered", "active"), low: int = 0) -> DataFrame:
    """Raise values below ``low`` to it; nulls stay null."""
    return df.withColumns({
        c: F.when(F.col(c) < low, F.lit(low)).otherwise(F.col(c))
        for c in columns if c in df.columns
    })


def with_calendar(df: DataFrame, column: str = "date") -> DataFrame:
    """Year, month, day of week (Monday = 0) and ISO week."""
    if column not in df.columns:
        return df
    c = F.col(column)
    return df.withColumns({
        "year": F.year(c),
        "month": F.month(c),
        "day_of_week": F.weekday(c),
        "week_of_year": F.weekofyear(c),
    })
