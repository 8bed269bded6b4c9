"""Transformation chains per data set."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame

from snapstats import schemas as S
from snapstats.operators import clean, dedup, series
from snapstats.plans import quality

log = logging.getLogger(__name__)


def dedup_order(df: DataFrame, dataset: str) -> list[str]:
    """What "last row" means: newest extraction, then file name and position in the landing.

    Rows without a recorded position are ordered by update time and then by every other
    sortable column, which makes the choice the same on each run.
    """
    first = [c for c in ("extraction_date", S.SEQUENCE_COLUMN) if c in df.columns]
    if S.SEQUENCE_COLUMN in df.columns:
        return first
    first += [c for c in ("updated",) if c in df.columns]
    keys = {"countries": ["country"], "historical": ["date", "country", "metric"]}.get(dataset, [])
    rest = sorted(
        f.name for f in df.schema.fields
        if f.name not in first + keys and "map" not in f.dataType.simpleString() and f.name != "processed_at"
    )
    return first + rest


def common_transform(df: DataFrame, dataset: str, as_of=None, exact: bool = True, order=None) -> DataFrame:
    """Names, missing values, types, derived columns, duplicates - in this order."""
    df = clean.standardize_names(df)
    df = clean.fill_counts(df)
    df = clean.fill_rates_with_median(df, exact)
    df = clean.fill_strings(df)
    df = clean.coerce_timestamps(df)
    df = clean.coerce_numerics(df)
    df = clean.with_freshness(df, as_of)
    df = clean.with_rates(df, dataset)
    return dedup.dedup(df, dataset, order or dedup_order(df, dataset))


def transform_series(df: DataFrame, on_zero: str = "null") -> DataFrame:
    """Calendar parts, daily changes and 7-row means of a deduplicated history."""
    if "date" in df.columns and df.schema["date"].dataType.typeName() != "date":
        df = df.withColumn("date", df["date"].cast("date"))
    df = clean.with_calendar(df)
    if not set(S.REQUIRED_COLUMNS["historical"]) <= set(df.columns):
        return df
    df = series.with_daily_change(df, on_zero=on_zero)
    df = series.with_rolling(df, "value")
    return series.with_rolling(df, "daily_change")


def transform_points(df: DataFrame, as_of=None) -> DataFrame:
    """A history's rows without the windows: cleaned, one per point, positions in the landing kept."""
    df = clean.with_region(common_transform(df, "historical", as_of), "historical")
    return clean.with_calendar(df.withColumn("date", df["date"].cast("date")))


def transform(df: DataFrame, dataset: str, as_of=None, exact: bool = True, order=None,
              unique_after_mapping: bool = False) -> DataFrame:
    """Full path of one data set.

    Countries are deduplicated before name variants are mapped, so two variants of one
    country both survive; ``unique_after_mapping`` keeps the last of them.
    """
    dataset = "historical" if dataset in S.SERIES_DATASETS else dataset
    df = common_transform(df, dataset, as_of, exact, order)
    if dataset == "countries":
        df = clean.standardize_places(df)
    df = clean.with_region(df, dataset)
    if dataset == "countries":
        df = clean.clip_lower(clean.drop_invalid(df, "country"))
        if unique_after_mapping:
            df = dedup.dedup_last(df, ["country"], order or dedup_order(df, dataset))
    elif dataset == "global":
        df = clean.ensure_columns(df, S.REQUIRED_COLUMNS["global"])
    elif dataset == "historical":
        df = transform_series(df)
    return df.drop(S.SEQUENCE_COLUMN)


def transform_all(bundle: dict[str, DataFrame], as_of=None, strict: bool = False, validate: bool = True,
                  exact: bool = True) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Transform every non-empty data set; returns (data, validation results).

    A failed validation is logged and the data kept, unless ``strict``.
    """
    data: dict[str, DataFrame] = {}
    results: dict[str, DataFrame] = {}
    for dataset, df in bundle.items():
        if df.isEmpty():
            log.warning("skipping empty data set %s", dataset)
            continue
        data[dataset] = transform(df, dataset, as_of, exact)
        if validate:
            results[dataset] = quality.validate(data[dataset], dataset, as_of)
            if strict:
                row = results[dataset].select("is_valid", "errors").first()
                if not row["is_valid"]:
                    raise ValueError(f"{dataset}: {row['errors']}")
    return data, results


def removed_counts(raw: dict[str, DataFrame], manifest: list[dict]) -> dict[str, int]:
    """Rows each data set lost on its way (duplicates, and regions without a name), from stored counts."""
    kept = {m["data_type"]: m["record_count"] for m in manifest if m["status"] != "failed"}
    return {dataset: df.count() - kept[dataset] for dataset, df in raw.items() if dataset in kept}


def simple_transform(df: DataFrame, dataset: str, as_of=None) -> DataFrame:
    """Short path: time conversion, two rates, processing time, numeric clean-up."""
    df = clean.epoch_ms_to_ts(df)
    df = clean.with_rates(df, dataset, zero="one")
    df = df.withColumn("processed_at", clean.clock(as_of))
    return clean.clean_numeric(df)
