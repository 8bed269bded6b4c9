"""Schemas, name tables and thresholds. Nothing here touches Spark data."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Payload schemas, per dataset (JSON field names as published).
# ---------------------------------------------------------------------------

_RAW_COUNTS = (
    "updated BIGINT, cases BIGINT, todayCases BIGINT, deaths BIGINT, todayDeaths BIGINT, "
    "recovered BIGINT, todayRecovered BIGINT, active BIGINT, critical BIGINT, "
    "casesPerOneMillion DOUBLE, deathsPerOneMillion DOUBLE, tests BIGINT, "
    "testsPerOneMillion DOUBLE, population BIGINT"
)
_RAW_PER_PEOPLE = "oneCasePerPeople DOUBLE, oneDeathPerPeople DOUBLE, oneTestPerPeople DOUBLE"
_RAW_PER_MILLION = (
    "activePerOneMillion DOUBLE, recoveredPerOneMillion DOUBLE, criticalPerOneMillion DOUBLE"
)
_RAW_SERIES = "cases MAP<STRING, BIGINT>, deaths MAP<STRING, BIGINT>, recovered MAP<STRING, BIGINT>"

RAW_SCHEMAS = {
    "global": f"{_RAW_COUNTS}, {_RAW_PER_PEOPLE}, {_RAW_PER_MILLION}, affectedCountries BIGINT",
    "countries": (
        f"{_RAW_COUNTS}, country STRING, "
        "countryInfo STRUCT<_id: INT, iso2: STRING, iso3: STRING, lat: DOUBLE, long: DOUBLE, flag: STRING>, "
        f"continent STRING, {_RAW_PER_PEOPLE}, {_RAW_PER_MILLION}"
    ),
    "continents": (
        f"{_RAW_COUNTS}, continent STRING, {_RAW_PER_MILLION}, "
        "continentInfo STRUCT<lat: DOUBLE, long: DOUBLE>, countries ARRAY<STRING>"
    ),
    "states": (
        "state STRING, updated BIGINT, cases BIGINT, deaths BIGINT, recovered BIGINT, "
        "casesPerOneMillion DOUBLE, deathsPerOneMillion DOUBLE, population BIGINT"
    ),
    "vaccines": "country STRING, timeline MAP<STRING, BIGINT>",
    "historical": _RAW_SERIES,
    "country_historical": f"country STRING, timeline STRUCT<{_RAW_SERIES.replace(' MAP', ': MAP')}>",
}

# ---------------------------------------------------------------------------
# Data sets, metrics and required columns.
# ---------------------------------------------------------------------------

SNAPSHOT_DATASETS = ("global", "countries", "continents", "states")
SERIES_DATASETS = ("historical", "country_historical")
METRICS = ("cases", "deaths", "recovered")
SERIES_DATE_FORMAT = "M/d/yy"
FIRST_VALID_DATE = "2019-12-01"

REQUIRED_COLUMNS = {
    "global": ("cases", "deaths", "recovered", "active"),
    "countries": ("country", "cases", "deaths"),
    "historical": ("date", "metric", "value", "country"),
}
NUMERIC_COLUMNS = {
    "global": ("cases", "deaths", "recovered", "active", "todaycases", "todaydeaths"),
}
CODE_LENGTHS = {"countries": {"country_iso2": 2, "country_iso3": 3}}

# Words that steer cleaning by column name.
COUNT_WORDS = ("cases", "deaths", "recovered", "tests", "population")
RATE_WORDS = ("rate", "per", "ratio", "percentage")
PLACE_WORDS = ("country", "continent")
TIME_WORDS = ("updated", "date")
NUMBER_WORDS = COUNT_WORDS + ("active", "critical", "today")

# Names that stand for "no country".
INVALID_NAMES = ("", "null", "undefined", "N/A")

# Country name variants and the standard names used for them.
COUNTRY_NAMES = {
    "US": "United States",
    "USA": "United States",
    "United States of America": "United States",
    "UK": "United Kingdom",
    "Britain": "United Kingdom",
    "Great Britain": "United Kingdom",
    "South Korea": "Korea, South",
    "North Korea": "Korea, North",
    "Russia": "Russian Federation",
    "Iran": "Iran, Islamic Republic of",
    "Syria": "Syrian Arab Republic",
    "Venezuela": "Venezuela, Bolivarian Republic of",
    "Bolivia": "Bolivia, Plurinational State of",
    "Tanzania": "Tanzania, United Republic of",
    "Moldova": "Moldova, Republic of",
    "Macedonia": "North Macedonia",
    "Czech Republic": "Czechia",
    "Myanmar": "Myanmar",
    "Burma": "Myanmar",
    "Congo (Kinshasa)": "Congo, Democratic Republic of the",
    "Congo (Brazzaville)": "Congo",
    "Ivory Coast": "Cote d'Ivoire",
}

# Members the completeness checks expect by default.
EXPECTED_CONTINENTS = ("Asia", "Europe", "North America", "South America", "Africa", "Oceania")
EXPECTED_COUNTRIES = (
    "United States", "China", "India", "Brazil", "Russia", "France", "Germany",
    "United Kingdom", "Italy", "Spain", "Iran", "South Korea", "Japan",
)
EXPECTED_STATES = (
    "California", "Texas", "Florida", "New York", "Pennsylvania", "Illinois",
    "Ohio", "Georgia", "North Carolina", "Michigan", "New Jersey", "Virginia",
)
MINIMUM_RECORDS = {"countries": 190, "continents": 6, "states": 50, "global": 1}

# ---------------------------------------------------------------------------
# Columns and types of the warehouse tables, in their order.
# ---------------------------------------------------------------------------

WAREHOUSE_TABLES = {
    "global": (
        "cases BIGINT, deaths BIGINT, recovered BIGINT, active BIGINT, critical BIGINT, today_cases BIGINT, "
        "today_deaths BIGINT, today_recovered BIGINT, cases_per_one_million DECIMAL(10,2), "
        "deaths_per_one_million DECIMAL(10,2), tests BIGINT, tests_per_one_million DECIMAL(10,2), population BIGINT, "
        "one_case_per_people DECIMAL(10,2), one_death_per_people DECIMAL(10,2), one_test_per_people DECIMAL(10,2), "
        "active_per_one_million DECIMAL(10,2), recovered_per_one_million DECIMAL(10,2), "
        "critical_per_one_million DECIMAL(10,2), affected_countries INT, updated TIMESTAMP, "
        "extraction_date TIMESTAMP, data_source STRING, data_type STRING, processed_at TIMESTAMP, "
        "data_freshness_hours DECIMAL(10,2), mortality_rate DECIMAL(10,6), recovery_rate DECIMAL(10,6), "
        "active_rate DECIMAL(10,6), region_type STRING, region_name STRING"),
    "countries": (
        "country STRING, country_iso2 STRING, country_iso3 STRING, country_id INT, country_lat DECIMAL(10,6), "
        "country_long DECIMAL(10,6), country_flag STRING, cases BIGINT, deaths BIGINT, recovered BIGINT, "
        "active BIGINT, critical BIGINT, today_cases BIGINT, today_deaths BIGINT, today_recovered BIGINT, "
        "cases_per_one_million DECIMAL(10,2), deaths_per_one_million DECIMAL(10,2), tests BIGINT, "
        "tests_per_one_million DECIMAL(10,2), population BIGINT, continent STRING, "
        "one_case_per_people DECIMAL(10,2), one_death_per_people DECIMAL(10,2), one_test_per_people DECIMAL(10,2), "
        "active_per_one_million DECIMAL(10,2), recovered_per_one_million DECIMAL(10,2), "
        "critical_per_one_million DECIMAL(10,2), updated TIMESTAMP, extraction_date TIMESTAMP, data_source STRING, "
        "data_type STRING, processed_at TIMESTAMP, data_freshness_hours DECIMAL(10,2), mortality_rate DECIMAL(10,6), "
        "recovery_rate DECIMAL(10,6), active_rate DECIMAL(10,6), cases_per_million DECIMAL(10,2), "
        "deaths_per_million DECIMAL(10,2), region_type STRING, region_name STRING"),
    "continents": (
        "continent STRING, cases BIGINT, deaths BIGINT, recovered BIGINT, active BIGINT, critical BIGINT, "
        "today_cases BIGINT, today_deaths BIGINT, today_recovered BIGINT, cases_per_one_million DECIMAL(10,2), "
        "deaths_per_one_million DECIMAL(10,2), tests BIGINT, tests_per_one_million DECIMAL(10,2), population BIGINT, "
        "active_per_one_million DECIMAL(10,2), recovered_per_one_million DECIMAL(10,2), "
        "critical_per_one_million DECIMAL(10,2), countries STRING, updated TIMESTAMP, extraction_date TIMESTAMP, "
        "data_source STRING, data_type STRING, processed_at TIMESTAMP, data_freshness_hours DECIMAL(10,2), "
        "mortality_rate DECIMAL(10,6), recovery_rate DECIMAL(10,6), active_rate DECIMAL(10,6), "
        "cases_per_million DECIMAL(10,2), deaths_per_million DECIMAL(10,2), region_type STRING, region_name STRING"),
    "states": (
        "state STRING, cases BIGINT, deaths BIGINT, recovered BIGINT, active BIGINT, today_cases BIGINT, "
        "today_deaths BIGINT, today_recovered BIGINT, cases_per_one_million DECIMAL(10,2), "
        "deaths_per_one_million DECIMAL(10,2), tests BIGINT, tests_per_one_million DECIMAL(10,2), population BIGINT, "
        "updated TIMESTAMP, extraction_date TIMESTAMP, data_source STRING, data_type STRING, processed_at TIMESTAMP, "
        "data_freshness_hours DECIMAL(10,2), mortality_rate DECIMAL(10,6), recovery_rate DECIMAL(10,6), "
        "active_rate DECIMAL(10,6), cases_per_million DECIMAL(10,2), deaths_per_million DECIMAL(10,2), "
        "region_type STRING, country STRING, region_name STRING"),
    "vaccines": (
        "country STRING, timeline STRING, extraction_date TIMESTAMP, data_source STRING, data_type STRING, "
        "processed_at TIMESTAMP, data_category STRING"),
    "historical": (
        "date DATE, metric STRING, value BIGINT, country STRING, extraction_date TIMESTAMP, data_source STRING, "
        "data_type STRING, processed_at TIMESTAMP, year INT, month INT, day_of_week INT, week_of_year INT, "
        "daily_change BIGINT, daily_change_pct DECIMAL(10,6), value_7day_avg DECIMAL(15,2), "
        "daily_change_7day_avg DECIMAL(15,2)"),
    "data_quality": (
        "table_name STRING, validation_timestamp TIMESTAMP, record_count BIGINT, expected_count BIGINT, "
        "count_match BOOLEAN, is_valid BOOLEAN, quality_score DECIMAL(5,2), errors STRING, warnings STRING, "
        "null_percentages STRING, duplicate_percentage DECIMAL(10,6), memory_usage_mb DECIMAL(10,2), "
        "extraction_date TIMESTAMP"),
    "pipeline_log": (
        "execution_id STRING, execution_date TIMESTAMP, task_name STRING, status STRING, start_time TIMESTAMP, "
        "end_time TIMESTAMP, duration_seconds INT, records_processed BIGINT, error_message STRING, "
        "created_at TIMESTAMP"),
}

# Longest text of a column; columns not named hold 100 characters.
TEXT_LENGTHS = {
    "country_iso2": 2, "country_iso3": 3, "country_flag": 500, "continent": 50, "data_source": 50, "data_type": 50,
    "region_type": 50, "data_category": 50, "metric": 50, "status": 50, "countries": 2000, "timeline": 10000, "errors": 2000,
    "warnings": 2000, "null_percentages": 2000, "error_message": 2000,
}
TEXT_LENGTH = 100

# The day column each warehouse table is partitioned by.
PARTITION_SOURCE = {
    "historical": "date",
    "data_quality": "validation_timestamp",
    "pipeline_log": "execution_date",
}
# The columns each table is sorted by within a day.
CLUSTER_COLUMNS = {
    "countries": ("country",),
    "continents": ("continent",),
    "states": ("state",),
    "vaccines": ("country",),
    "historical": ("country", "metric"),
    "data_quality": ("table_name",),
    "pipeline_log": ("task_name", "status"),
}
PARTITION_COLUMN = "snapshot_date"
RUN_COLUMN = "load_run"             # partition beside the day: which run loaded a row
SEQUENCE_COLUMN = "ingest_seq"      # position of a row in its landing file


@lru_cache
def warehouse_schema(table: str) -> T.StructType:
    """Fixed schema of a warehouse table, in column order."""
    return T.StructType.fromDDL(WAREHOUSE_TABLES[table])


def raw_schema(dataset: str) -> T.StructType:
    """Payload schema of a landing dataset."""
    return T.StructType.fromDDL(RAW_SCHEMAS[dataset])


def warehouse_name(column: str, table: str) -> str:
    """Warehouse spelling of a standardised column (``todaycases`` -> ``today_cases``)."""
    squeezed = column.replace("_", "")
    for candidate in warehouse_schema(table).names:
        if candidate.replace("_", "") == squeezed:
            return candidate
    return column
