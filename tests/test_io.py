import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from snapstats import schemas as S
from snapstats.operators import clean
from snapstats.plans import quality, transforms
from snapstats.sources import readers, writers

import landing as L

NOW = "2024-05-01 06:00:00"


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return L.write(str(tmp_path_factory.mktemp("landing")))


def test_read_snapshots(spark, landing):
    world = readers.read_snapshot(spark, f"{landing}/global", "global", NOW)
    row = world.first()
    assert row["updated"] == dt.datetime(2024, 5, 1) and row["extraction_date"] == dt.datetime(2024, 5, 1, 6)
    assert (row["data_type"], row["affectedCountries"], row["casesPerOneMillion"]) == ("global", 231, 100.5)
    countries = readers.read_snapshot(spark, f"{landing}/countries", "countries", NOW)
    assert "countryInfo" not in countries.columns
    assert {(r["country"], r["country__id"], r["country_iso3"]) for r in countries.collect()} == {
        ("US", 1, "XXX"), ("peru ", 2, "XXX"), ("Iran", 3, "XXX")}
    continents = readers.read_snapshot(spark, f"{landing}/continents", "continents", NOW)
    assert continents.first()["countries"] == ["A", "B"] and continents.count() == 3
    assert "active" not in readers.read_snapshot(spark, f"{landing}/states", "states").columns


def test_histories(spark, landing):
    world = readers.read_series(spark, f"{landing}/historical", "historical", NOW)
    assert world.count() == 5 and {r["metric"] for r in world.collect()} == {"cases", "deaths"}
    assert {r["country"] for r in world.collect()} == {"Global"}
    recent = readers.read_series(spark, f"{landing}/historical", "historical", NOW, days=2)
    assert sorted((str(r["date"]), r["value"]) for r in recent.collect()) == [("2024-04-30", 1), ("2024-04-30", 40)]
    # The broken document is skipped, object and list form are both read.
    local = readers.read_series(spark, f"{landing}/country_historical", "country_historical", NOW)
    assert sorted((r["country"], str(r["date"]), r["metric"], r["value"]) for r in local.collect()) == [
        ("Chile", "2024-04-30", "cases", 9), ("Peru", "2024-04-29", "cases", 1), ("Peru", "2024-04-30", "cases", 3),
        ("Peru", "2024-04-30", "deaths", 1)]
    some = readers.read_series(spark, f"{landing}/country_historical", "country_historical", NOW, countries=["Peru"], days=1)
    assert some.count() == 2


def test_vaccines_long(spark, landing):
    vaccines = readers.read_snapshot(spark, f"{landing}/vaccines", "vaccines", NOW)
    assert [(str(r["date"]), r["doses"]) for r in readers.vaccines_long(vaccines).orderBy("date").collect()] == [
        ("2024-04-29", 5), ("2024-04-30", 7)]


def test_python_literals(spark):
    df = spark.createDataFrame([("{'_id': 4, 'iso2': 'AF', 'lat': 33}", "['a', 'b']"),
                                ("{'_id': None, 'iso2': 'None', 'lat': None}", """['None', "d'I", None]""")], "i STRING, c STRING")
    last = df.select(readers.parse_literal("i", "_id INT, iso2 STRING, lat DOUBLE").alias("i"),
                     readers.parse_literal("c", "ARRAY<STRING>").alias("c")).tail(1)[0]
    assert (tuple(last["i"]), last["c"]) == ((None, "None", None), ["None", "d'I", None])
    row = df.select(readers.parse_literal("i", "_id INT, iso2 STRING, lat DOUBLE").alias("i"),
                    readers.parse_literal("c", "ARRAY<STRING>").alias("c")).first()
    assert (row["i"]["_id"], row["i"]["lat"], row["c"]) == (4, 33.0, ["a", "b"])


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [(1, 'say "hi", you', dt.datetime(2024, 5, 1, 1, 2, 3, 456789), None), (2, None, None, 2.5)],
        "id BIGINT, text STRING, updated TIMESTAMP, x DOUBLE")


@pytest.mark.parametrize("fmt", readers.FORMATS)
def test_round_trip(spark, sample, tmp_path, fmt):
    uri = writers.write_dataset(sample, f"{tmp_path}/out.{fmt}", fmt)
    back = readers.read_dataset(spark, uri, schema=sample.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, sample.collect()))


def test_line_breaks_in_csv_cells(spark, tmp_path):
    df = spark.createDataFrame([(i, 'a\n"b"\r\nc') for i in range(20)], "id INT, text STRING")
    manifest = writers.write_bundle({"notes": df}, str(tmp_path), "csv", "s")
    assert manifest[0]["record_count"] == 20
    back = writers.read_bundle(spark, manifest, {"notes": df.schema})["notes"]
    assert {r["id"] for r in back.collect()} == set(range(20))
    assert {r["text"].replace("\r\n", "\n") for r in back.collect()} == {'a\n"b"\nc'}


def test_unknown_format(spark, sample, tmp_path):
    with pytest.raises(ValueError):
        writers.write_dataset(sample, str(tmp_path), "xml")
    with pytest.raises(ValueError):
        readers.read_dataset(spark, str(tmp_path), "xml")


def test_csv_keeps_nested_columns_as_json(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, map('k', 2) AS m, array('x') AS l")
    uri = writers.write_dataset(df, f"{tmp_path}/n.csv", "csv")
    assert tuple(readers.read_dataset(spark, uri).first()) == ("1", '{"k":2}', '["x"]')


def test_latest_file(spark, tmp_path):
    for stamp, value in (("20240101_000000", 1), ("20240301_000000", 3), ("20240201_000000", 2)):
        with open(f"{tmp_path}/data_{stamp}.csv", "w") as out:
            out.write(f"v\n{value}\n")
    df = readers.read_dataset(spark, str(tmp_path), "csv", "v INT")
    assert [r["v"] for r in readers.latest_file(df).collect()] == [3]


def test_write_bundle_skips_empty_and_isolates_failures(spark, sample, tmp_path):
    broken = sample.select(F.raise_error(F.lit("no")).cast("string").alias("a"))
    bundle = {"good": sample, "none": sample.limit(0), "bad": broken}
    manifest = writers.write_bundle(bundle, str(tmp_path), stamp="s1", strict=False)
    assert [(m["data_type"], m["status"], m["record_count"], m["column_count"]) for m in manifest] == [
        ("good", "written", 2, 4), ("none", "empty", 0, 4), ("bad", "failed", 0, 1)]
    assert writers.manifest_frame(spark, manifest).count() == 3
    assert set(writers.read_bundle(spark, manifest)) == {"good"}
    with pytest.raises(Exception):
        writers.write_bundle({"bad": broken}, str(tmp_path), stamp="s2")


def test_sink_coercions(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05.678' AS t, true AS b, CAST(NULL AS STRING) AS s, CAST(NULL AS INT) AS n, "
                   "'nan' AS x, map('k', 1) AS m")
    assert tuple(writers.coerce_text_sink(df).drop("m", "x").first()) == ("2024-01-02 03:04:05", 1, "", None)
    assert tuple(writers.coerce_string_sink(df).select("x", "m").first()) == (None, '{"k":1}')


def test_conform(spark, landing):
    raw = readers.read_snapshot(spark, f"{landing}/countries", "countries", NOW)
    out = writers.conform_to_warehouse(transforms.transform(raw, "countries", NOW), "countries")
    assert out.schema.simpleString() == S.warehouse_schema("countries").simpleString()
    row = out.filter("country = 'United States'").first()
    assert row["cases"] == 2000         # the later of two rows in the document
    assert (row["today_cases"], str(row["cases_per_one_million"]), row["country_id"], str(row["mortality_rate"])) == (
        5, "100.50", 1, "0.010000")
    assert row["one_test_per_people"] == 2


def test_tables(spark, landing):
    assert set(writers.create_tables(spark, prefix="t_").values()) == {None}
    assert {"t_countries", "t_pipeline_log"} <= {t.name for t in spark.catalog.listTables()}
    raw = readers.read_all(spark, landing, NOW)
    data, results = transforms.transform_all(raw, NOW)
    assert writers.load_tables({**data, "nothing": raw["states"].limit(0)}, "t_") == {f"t_{k}": None for k in data}
    assert spark.table("t_historical").count() == 5
    assert spark.table("t_continents").count() == 2
    info = writers.table_info(spark, "t_countries").first()
    assert info["record_count"] == 3 and info["size_bytes"] > 0
    plan = spark.table("t_countries").filter("snapshot_date = DATE '2024-05-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    for df in results.values():
        writers.write_quality(df, "t_data_quality")
    assert spark.table("t_data_quality").count() == len(results)
    assert writers.run_sql(spark, "WITH x AS (SELECT * FROM t_states WHERE state = :s) SELECT count(*) AS n FROM x",
                           {"s": "Guam"}).first()["n"] == 1


def test_load_modes(spark, sample):
    writers.load_table(sample, "modes", "fail")
    with pytest.raises(Exception):
        writers.load_table(sample, "modes", "fail")
    writers.load_table(sample.select("x", "updated", "id", "text"), "modes", "append")
    assert spark.table("modes").count() == 4
    writers.load_table(sample, "modes", "replace")
    assert spark.table("modes").count() == 2


def test_reconcile(spark):
    actual = spark.createDataFrame([("a",), ("a",), ("b",)], "table_name STRING")
    expected = spark.createDataFrame([("a", 2), ("b", 2), ("c", 0)], "table_name STRING, expected_count BIGINT")
    got = {r["table_name"]: (r["actual_count"], r["is_valid"], r["errors"]) for r in writers.reconcile_load(actual, expected).collect()}
    assert got == {"a": (2, True, None), "b": (1, False, "expected 2 records, found 1"), "c": (0, True, None)}


def test_upsert_table_touches_only_its_days(spark, tmp_path):
    path = f"{tmp_path}/table"
    day = lambda d: dt.date(2024, 1, d)
    cols = "country STRING, v INT, snapshot_date DATE"
    spark.createDataFrame([("A", 1, day(1)), ("B", 1, day(1)), ("A", 1, day(2))], cols).write.partitionBy("snapshot_date").parquet(path)
    untouched = set(glob.glob(f"{path}/snapshot_date=2024-01-02/*.parquet"))
    new = spark.createDataFrame([("A", 5, day(1)), ("C", 1, day(3))], cols)
    assert sorted(writers.upsert_table(spark, path, new, ["country", "snapshot_date"], ["v"])) == [day(1), day(3)]
    got = sorted((r["country"], r["v"], r["snapshot_date"].day) for r in spark.read.parquet(path).collect())
    assert got == [("A", 1, 2), ("A", 5, 1), ("B", 1, 1), ("C", 1, 3)]
    assert set(glob.glob(f"{path}/snapshot_date=2024-01-02/*.parquet")) == untouched


def test_retention_drops_partitions(spark, sample):
    rows = spark.createDataFrame([(i, dt.date(2024, 1, i)) for i in range(1, 8)], "v INT, snapshot_date DATE")
    writers.load_table(rows, "aged", "replace", ("snapshot_date",))
    assert writers.drop_expired(spark, "aged", 3, "2024-01-07") == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert spark.table("aged").count() == 4


def test_inventory_reads_no_contents(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.bin").write_bytes(b"x" * (i + 1))
    files = writers.file_inventory(spark, str(tmp_path))
    assert sorted(os.path.basename(r["key"]) for r in files.collect()) == ["f0.bin", "f1.bin", "f2.bin"]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    info = writers.storage_info(files).first()
    assert (info["total_objects"], info["total_size_bytes"]) == (3, 6) and info["last_modified"]


@pytest.mark.skipif(not os.environ.get("SNAPSTATS_GOLDEN_DIR"), reason="no folder with raw/ and processed/ files")
@pytest.mark.parametrize("dataset", ["global", "continents", "states"])
def test_golden(spark, dataset):
    """Raw files through the short path equal the processed files, all columns but processed_at."""
    base = os.environ["SNAPSTATS_GOLDEN_DIR"]
    raw_file, = glob.glob(f"{base}/raw/*_{dataset}_raw_*.csv")
    done_file, = glob.glob(f"{base}/processed/*_{dataset}_processed_*.csv")
    kinds = {f.name: f.dataType.simpleString() for f in S.raw_schema(dataset).fields if "<" not in f.dataType.simpleString()}
    kinds.update(extraction_date="timestamp", mortality_rate="double", recovery_rate="double")

    def load(path, **more):
        df = readers.read_dataset(spark, path, "csv")
        return df.select(*[F.col(c).cast({**kinds, **more}.get(c, "string")).alias(c) for c in df.columns])

    got = transforms.simple_transform(load(raw_file), dataset, NOW).drop("processed_at")
    want = load(done_file, updated="timestamp").drop("processed_at")
    assert got.columns == want.columns
    assert got.count() == want.count()
    assert got.exceptAll(want.select(got.columns)).isEmpty() and want.exceptAll(got).isEmpty()


def test_lineage_report(spark, landing):
    df = clean.with_freshness(readers.read_snapshot(spark, f"{landing}/states", "states", NOW, "files"), NOW)
    from snapstats.plans import reports
    assert reports.lineage(df).first().asDict() == {
        "updated": dt.datetime(2024, 5, 1), "extraction_date": dt.datetime(2024, 5, 1, 6),
        "processed_at": dt.datetime(2024, 5, 1, 6), "data_source": "files"}
    assert quality.file_quality({"s": df}).first()["has_processed_at"] is True
