import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapstats import schemas as S
from snapstats.functions import columns as C
from snapstats.operators import clean
from snapstats.plans import transforms

NOW = "2024-05-01 12:00:00"


def rows(df, *names):
    return [tuple(r) for r in df.select(*(names or df.columns)).collect()]


def test_standard_name():
    assert [clean.standard_name(n) for n in ("todayCases", "country__id", " Case-Fatality (%) ", "__x__", "A.B")] == [
        "todaycases", "country_id", "case_fatality", "x", "a_b"]


def test_rates_guard_zero_null_and_negative(spark):
    df = spark.createDataFrame(
        [(10, 1, 5, 4, 100), (0, 3, 0, 0, 0), (None, 3, 1, 1, None), (-5, 1, 1, 1, -7)],
        "cases BIGINT, deaths BIGINT, recovered BIGINT, active BIGINT, population BIGINT")
    got = rows(clean.with_rates(df), "mortality_rate", "recovery_rate", "active_rate", "cases_per_million", "deaths_per_million")
    assert got == [(0.1, 0.5, 0.4, 100000.0, 10000.0)] + [(0.0,) * 5] * 3


def test_rates_zero_as_one_and_other_datasets(spark):
    df = spark.createDataFrame([(0, 3, 2), (4, 1, 2)], "cases BIGINT, deaths BIGINT, recovered BIGINT")
    assert rows(clean.with_rates(df, zero="one"), "mortality_rate", "recovery_rate") == [(3.0, 2.0), (0.25, 0.5)]
    assert clean.with_rates(df, "historical").columns == df.columns
    assert "cases_per_million" not in clean.with_rates(df).columns


def test_per_100k_null_on_zero(spark):
    df = spark.createDataFrame([(5, 1000), (5, 0)], "cases BIGINT, population BIGINT")
    assert rows(clean.with_per_100k(df), "cases_per_100k") == [(500.0,), (None,)]


def test_fill_counts_rates_strings(spark):
    df = spark.createDataFrame(
        [(None, 1.0, None, None), (4, None, "x", "a"), (6, 5.0, "y", None), (1, float("nan"), "y", "b")],
        "cases BIGINT, active_rate DOUBLE, country STRING, flag STRING")
    filled = clean.fill_strings(clean.fill_rates_with_median(clean.fill_counts(df)))
    assert rows(filled) == [(0, 1.0, "Unknown", "N/A"), (4, 3.0, "x", "a"), (6, 5.0, "y", "N/A"), (1, 3.0, "y", "b")]


def test_count_words_win_over_rate_words(spark):
    df = spark.createDataFrame([(None, None), (8.0, 8.0)], "casesperonemillion DOUBLE, criticalperonemillion DOUBLE")
    assert rows(clean.fill_rates_with_median(clean.fill_counts(df))) == [(0.0, 8.0), (8.0, 8.0)]


def test_all_null_rate_stays_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "some_rate DOUBLE")
    assert rows(clean.fill_rates_with_median(df)) == [(None,), (None,)]


def test_coerce_timestamps(spark):
    df = spark.createDataFrame(
        [(1760635516298, "2025-10-16 22:57:40", "1/22/20"), (None, "nonsense", "13/45/20")],
        "updated BIGINT, extraction_date STRING, date STRING")
    got = rows(clean.coerce_timestamps(df))
    assert got[0] == (dt.datetime(2025, 10, 16, 17, 25, 16, 298000), dt.datetime(2025, 10, 16, 22, 57, 40),
                      dt.datetime(2020, 1, 22))
    assert got[1] == (None, None, None)


def test_coerce_and_clean_numbers(spark):
    df = spark.createDataFrame([("12", "x", 3), (" 7.5 ", None, None)], "cases STRING, active STRING, critical INT")
    assert rows(clean.coerce_numerics(df)) == [(12.0, None, 3), (7.5, None, None)]
    assert rows(clean.clean_numeric(df)) == [(12.0, 0.0, 3), (7.5, 0.0, 0)]


def test_epoch_ms_bad_text(spark):
    df = spark.createDataFrame([("1000",), ("oops",)], "updated STRING")
    assert rows(clean.epoch_ms_to_ts(df)) == [(dt.datetime(1970, 1, 1, 0, 0, 1),), (None,)]


def test_freshness(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 5, 1, 10, 30),), (None,)], "updated TIMESTAMP")
    assert [r[0] for r in rows(clean.with_freshness(df, NOW), "data_freshness_hours")] == [1.5, None]
    assert rows(clean.with_freshness(df.drop("updated"), NOW), "data_freshness_hours") == [(None,), (None,)]


@pytest.mark.parametrize("text, expected", [
    ("cote d'IVOIRE", "Cote D'Ivoire"), ("  guinea-bissau ", "Guinea-Bissau"), ("élan 3rd", "Élan 3Rd"),
    ("Iran, Islamic Republic of", "Iran, Islamic Republic Of"), ("", ""), (None, None), ("a中b", "A中B")])
def test_title_case(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert rows(df.select(C.title_case("t").alias("t"))) == [(expected,)]
    if text and "中" not in text:
        assert expected == text.strip().title()


def test_places_map_before_trim(spark):
    df = spark.createDataFrame([("US",), (" US ",), ("South Korea",), ("DRC",)], "country STRING")
    assert [r[0] for r in rows(clean.standardize_places(df))] == ["United States", "Us", "Korea, South", "Drc"]


def test_map_values_from_table_keeps_rows_and_order_of_columns(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(300)] + [(900, "cold")], "id INT, name STRING")
    table = spark.createDataFrame([("hot", "HOT"), ("unused", "-")], "old STRING, new STRING")
    out = clean.map_values(df, "name", table)
    assert out.columns == ["id", "name"]
    assert {r["id"]: r["name"] for r in out.collect()} == {
        **{i: "HOT" if i % 3 else None for i in range(300)}, 900: "cold"}


def test_drop_invalid_and_clip(spark):
    df = spark.createDataFrame(
        [("", 1), ("Null", 1), ("undefined", 1), ("N/A", 1), (None, -3), ("Peru", None)], "country STRING, cases INT")
    assert rows(clean.clip_lower(clean.drop_invalid(df, "country"))) == [(None, 0), ("Peru", None)]
    assert ("Null", 1) in rows(clean.drop_invalid(df, "country", ignore_case=False))


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 1, 1),)], "date DATE")
    assert rows(clean.with_calendar(df), "year", "month", "day_of_week", "week_of_year") == [(2024, 1, 0, 1), (2023, 1, 6, 52)]


def test_regions(spark):
    df = spark.createDataFrame([("Ohio",)], "state STRING")
    assert rows(clean.with_region(df, "states"), "region_type", "region_name", "country") == [("state", "Ohio", "USA")]
    assert rows(clean.with_region(df, "global"), "region_type", "region_name") == [("global", "World")]
    assert rows(clean.with_region(df, "vaccines"), "data_category") == [("vaccination",)]


def test_flatten_struct(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('_id', 4, 'iso2', 'AF') AS countryInfo")
    flat = clean.standardize_names(clean.flatten_struct(df, "countryInfo", "country_"))
    assert flat.columns == ["a", "country_id", "country_iso2"] and rows(flat) == [(1, 4, "AF")]


def test_transform_countries_keeps_last_and_renames(spark):
    df = spark.createDataFrame([
        (1, "US", 5, 1, 2, 2, 10, "2024-04-30 00:00:00"), (2, "US", 9, 1, 2, 6, 10, "2024-05-01 00:00:00"),
        (3, "USA", 7, 1, 2, 4, 10, "2024-04-29 00:00:00"), (4, "n/a", 7, 1, 2, 4, 10, "2024-04-29 00:00:00"),
        (5, "Peru", -7, 1, 2, 4, 0, "2024-04-29 00:00:00")],
        "updated BIGINT, country STRING, cases BIGINT, deaths BIGINT, recovered BIGINT, active BIGINT, population BIGINT, extraction_date STRING")
    out = transforms.transform(df, "countries", NOW)
    assert sorted(rows(out, "country", "cases")) == [("Peru", 0), ("United States", 7), ("United States", 9)]
    once = transforms.transform(df, "countries", NOW, unique_after_mapping=True)
    assert sorted(rows(once, "country", "cases")) == [("Peru", 0), ("United States", 9)]


def test_nested_datasets_pass_the_full_path(spark):
    continents = spark.sql("""SELECT 'Asia' AS continent, 5L AS cases, 1L AS deaths, named_struct('lat', 1.0D) AS continentInfo,
      array('Japan', 'India') AS countries UNION ALL SELECT 'Asia', 5L, 1L, named_struct('lat', 1.0D), array('Japan', 'India')""")
    assert transforms.transform(continents, "continents", NOW).count() == 1
    vaccines = spark.sql("SELECT 'Peru' AS country, map('1/1/21', 5L, '1/2/21', 7L) AS timeline UNION ALL "
                         "SELECT 'Peru', map('1/2/21', 7L, '1/1/21', 5L)")
    out = transforms.transform(vaccines, "vaccines", NOW).collect()
    assert len(out) == 1 and out[0]["timeline"] == {"1/1/21": 5, "1/2/21": 7}


def test_warehouse_types(spark):
    kinds = {f.name: f.dataType.simpleString() for t in S.WAREHOUSE_TABLES for f in S.warehouse_schema(t).fields}
    wanted = {
        "cases": "bigint", "today_cases": "bigint", "tests_per_one_million": "decimal(10,2)",
        "one_case_per_people": "decimal(10,2)", "mortality_rate": "decimal(10,6)", "country_lat": "decimal(10,6)",
        "data_freshness_hours": "decimal(10,2)", "value_7day_avg": "decimal(15,2)", "quality_score": "decimal(5,2)",
        "date": "date", "updated": "timestamp", "is_valid": "boolean", "country": "string", "week_of_year": "int",
        "critical_per_one_million": "decimal(10,2)", "deaths_per_million": "decimal(10,2)", "daily_change": "bigint",
        "daily_change_pct": "decimal(10,6)"}
    assert {c: kinds[c] for c in wanted} == wanted


def test_no_lineage_clock_default(spark):
    df = clean.with_lineage(spark.range(1), None, "s", "t")
    assert df.filter(F.col("extraction_date").isNotNull()).count() == 1
