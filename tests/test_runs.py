import datetime as dt
import json
import os

import pytest

from snapstats import catalog
from snapstats.catalog import QUERIES
from snapstats.plans import runs
from snapstats.sources import readers, writers
from snapstats.streaming import ingest

import landing as L

NOW = "2024-05-01 06:00:00"


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return L.write(str(tmp_path_factory.mktemp("landing")))


def test_full_run(spark, landing, tmp_path):
    out = str(tmp_path)
    result = runs.run_steps(spark, landing, out, NOW, prefix="r_", execution_id="one", log_table="r_log",
                            quality_table="r_quality")
    assert result["status"] == "success"
    assert [(s["task_name"], s["status"]) for s in result["steps"]] == [
        ("extract", "success"), ("transform", "success"), ("store", "success"), ("load", "success")]
    assert result["load"] == {f"r_{d}": None for d in ("global", "countries", "continents", "states", "vaccines", "historical")}
    counts = {m["data_type"]: m["record_count"] for m in result["transform"]}
    assert counts == {"global": 1, "countries": 3, "continents": 2, "states": 2, "vaccines": 1, "historical": 5}
    # A second run appends; each run still reconciles by its own extraction.
    later = runs.run_steps(spark, landing, out, "2024-05-02 06:00:00", prefix="r_", execution_id="two")
    assert spark.table("r_states").count() == 4
    for stamp, run in ((NOW, result), ("2024-05-02 06:00:00", later)):
        checked = runs.reconcile(spark, run["transform"], "r_", stamp).collect()
        assert len(checked) == 6 and all(r["is_valid"] for r in checked)
        assert len(run["reconcile"]) == 6 and all(r["is_valid"] for r in run["reconcile"])
    assert {r["expected_count"] for r in spark.table("r_quality").collect()} >= {1, 2, 3, 5}
    assert set(result["removed"]) == set(counts) and result["removed"]["countries"] >= 0
    assert spark.read.json(f"{out}/quality/run=one").count() == 6
    assert spark.table("r_log").count() == 4
    assert {r["table_name"] for r in spark.table("r_quality").collect()} == set(counts)
    log = spark.read.schema(writers.RUN_LOG_SCHEMA).json(f"{out}/run_log").filter("execution_id = 'one'")
    summary = runs.run_summary(writers.manifest_frame(spark, result["transform"]), log).first()
    assert (summary["datasets"], summary["total_records"], summary["steps_succeeded"], summary["steps_failed"]) == (6, 14, 4, 0)


def test_steps_alone_and_skipped(spark, landing, tmp_path):
    out = str(tmp_path)
    assert runs.run_steps(spark, landing, out, NOW, step="extract", execution_id="x", include_history=False)["status"] == "success"
    assert runs.run_steps(spark, landing, out, NOW, step="transform", execution_id="x")["status"] == "success"
    skipped = runs.run_steps(spark, landing, out, NOW, skip=("store", "load"), execution_id="y")
    assert [s["status"] for s in skipped["steps"]] == ["success", "success", "skipped", "skipped"]
    with pytest.raises(ValueError):
        runs.run_steps(spark, landing, out, NOW, step="ship")


def test_failed_core_step_stops(spark, tmp_path):
    result = runs.run_steps(spark, f"{tmp_path}/missing", str(tmp_path), NOW)
    assert result["status"] == "failed"
    assert [(s["task_name"], s["status"]) for s in result["steps"]] == [("extract", "failed")]


def test_stream_takes_each_file_once(spark, tmp_path):
    landing, out, marks = (f"{tmp_path}/{n}" for n in ("countries", "out", "marks"))
    (tmp_path / "countries").mkdir()

    def drop(name, rows):
        (tmp_path / "countries" / name).write_text(json.dumps(rows))

    drop("a.json", [L.country("Peru", 1), L.country("Peru", 1, cases=7)])
    ingest.ingest_available_now(spark, landing, "countries", out, marks, NOW)
    drop("b.json", [L.country("Chile", 2)])
    ingest.ingest_available_now(spark, landing, "countries", out, marks, NOW)
    ingest.ingest_available_now(spark, landing, "countries", out, marks, NOW)
    rows = spark.read.parquet(f"{out}/data").select("country", "cases", "snapshot_date").orderBy("country").collect()
    assert [tuple(r) for r in rows] == [("Chile", 1000, dt.date(2024, 5, 1)), ("Peru", 7, dt.date(2024, 5, 1))]
    # Another delivery of the same extraction: still one row, the last one.
    drop("c.json", [L.country("Peru", 1, cases=9)])
    ingest.ingest_available_now(spark, landing, "countries", out, marks, NOW)
    assert {r["country"]: r["cases"] for r in spark.read.parquet(f"{out}/data").collect()} == {"Chile": 1000, "Peru": 9}


def test_stream_of_histories_matches_batch(spark, landing, tmp_path):
    out = f"{tmp_path}/out"
    streamed = ingest.ingest_available_now(spark, f"{landing}/historical", "historical", out, f"{tmp_path}/marks", NOW)
    batch = readers.read_series(spark, f"{landing}/historical", "historical", NOW)
    key = lambda df: sorted((r["metric"], str(r["date"]), r["value"]) for r in df.collect())
    assert key(streamed) == key(batch)
    assert {"daily_change", "value_7day_avg", "week_of_year"} <= set(streamed.columns)


def test_batches_do_not_change_the_answer(spark, tmp_path):
    """One file at a time, two, all at once, and the batch path agree, value by value."""
    folder = tmp_path / "historical"
    folder.mkdir()
    for day in range(1, 5):
        for name, base in (("a", 10), ("b", 5)):
            (folder / f"{name}{day}.json").write_text(json.dumps({"cases": {f"4/{day}/24": base * day * day}, "deaths": {f"4/{day}/24": day}}))
    (folder / "c.json").write_text(json.dumps({"cases": {"4/2/24": 90, "4/3/24": "2.5x", "4/4/24": 2.5}}))
    (folder / "d.json").write_text('{"cases": {')
    from snapstats.plans import transforms

    columns = ("date", "metric", "value", "daily_change", "value_7day_avg", "daily_change_7day_avg")
    key = lambda df: sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    batch = transforms.transform(readers.read_series(spark, str(folder), "historical", NOW), "historical", NOW)
    want = key(batch)
    assert ("2024-04-02", "cases", "90", "85", "47.5", "85.0") in [(a, b, c, d, e, f) for a, b, c, d, e, f in want]
    rejects = sorted((r["file"], r["reason"], r["record"]) for r in readers.read_rejects(spark, str(folder), "historical").collect())
    assert rejects == [("c.json", "unreadable value", "cases 4/3/24 2.5x"), ("c.json", "unreadable value", "cases 4/4/24 2.5"),
                       ("d.json", "malformed document", '{"cases": {')]
    for files in (1, 2, 1000):
        out = f"{tmp_path}/out{files}"
        got = ingest.ingest_available_now(spark, str(folder), "historical", out, f"{tmp_path}/marks{files}", NOW, max_files=files)
        assert key(got) == want
        kept = spark.read.schema(readers.REJECTS).parquet(f"{out}/rejects").collect()
        assert sorted((r["file"], r["reason"], r["record"]) for r in kept) == rejects


def test_broken_snapshots_are_listed_not_read(spark, tmp_path):
    folder = tmp_path / "countries"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([L.country("Peru", 1, cases=5)]))
    (folder / "b.json").write_text('[{"country": "Chile", ')
    (folder / "c.json").write_text(json.dumps(L.country("Cuba", 2, deaths="many")))
    rows = readers.read_snapshot(spark, str(folder), "countries", NOW)
    assert sorted((r["country"], r["cases"], r["deaths"]) for r in rows.collect()) == [("Cuba", 1000, None), ("Peru", 5, 20)]
    found = sorted((r["file"], r["reason"]) for r in readers.read_rejects(spark, str(folder), "countries").collect())
    assert found == [("b.json", "malformed document"), ("c.json", "unreadable field")]
    got = ingest.ingest_available_now(spark, str(folder), "countries", f"{tmp_path}/out", f"{tmp_path}/marks", NOW)
    assert sorted(r["country"] for r in got.collect()) == ["Cuba", "Peru"]


def test_newer_file_wins_whatever_its_size(spark, tmp_path):
    from snapstats.plans import transforms

    for number, (old, new) in enumerate(((1, 31), (31, 1))):
        folder = tmp_path / f"countries{number}"
        folder.mkdir()
        for name, rows, cases in (("c_20240501.json", old, 1), ("c_20240502.json", new, 2)):
            (folder / name).write_text(json.dumps([L.country(f"Land {k}", k) for k in range(rows - 1)] + [L.country("Peru", 1, cases=cases)]))
        kept = transforms.transform(readers.read_snapshot(spark, str(folder), "countries", NOW), "countries", NOW)
        assert [r["cases"] for r in kept.filter("country = 'Peru'").collect()] == [2]
        history = tmp_path / f"historical{number}"
        history.mkdir()
        for name, days, value in (("h_20240501.json", old, 100), ("h_20240502.json", new, 90)):
            (history / name).write_text(json.dumps({"cases": {f"3/{d + 1}/24": value for d in range(days)}}))
        kept = transforms.transform(readers.read_series(spark, str(history), "historical", NOW), "historical", NOW)
        assert [r["value"] for r in kept.filter("date = DATE '2024-03-01'").collect()] == [90]


def test_one_table_that_fails_is_reported(spark, landing, tmp_path):
    spark.sql("CREATE TABLE IF NOT EXISTS bad_states (x INT) USING parquet")
    result = runs.run_steps(spark, landing, str(tmp_path), NOW, prefix="bad_", execution_id="bad", include_history=False)
    assert result["status"] == "partial"
    assert result["load"]["bad_states"] and result["load"]["bad_countries"] is None
    step = result["steps"][-1]
    assert step["status"] == "partial" and "bad_states" in step["error_message"]
    assert {r["table_name"] for r in result["reconcile"]} == {f"bad_{d}" for d in ("global", "countries", "continents", "vaccines")}


def test_upsert_keeps_the_null_day_and_moves_keys(spark, tmp_path):
    old = spark.sql("""SELECT * FROM VALUES ('keep', CAST(NULL AS DATE), 1), ('a', DATE '2024-05-01', 2), ('b', DATE '2024-05-02', 3),
                       ('c', DATE '2024-05-03', 4) AS t(id, snapshot_date, n)""")
    path = writers.write_dataset(old, f"{tmp_path}/t", partition_by=("snapshot_date",))
    new = spark.sql("SELECT * FROM VALUES ('a', DATE '2024-05-03', 20), ('d', CAST(NULL AS DATE), 5) AS t(id, snapshot_date, n)")
    touched = writers.upsert_table(spark, path, new, ["id"], [])
    assert set(touched) == {None, dt.date(2024, 5, 1), dt.date(2024, 5, 3)}
    rows = sorted((r["id"], str(r["snapshot_date"]), r["n"]) for r in spark.read.parquet(path).collect())
    assert rows == [("a", "2024-05-03", 20), ("b", "2024-05-02", 3), ("c", "2024-05-03", 4), ("d", "None", 5), ("keep", "None", 1)]


def test_every_query_of_a_run_does_the_run(spark, small, tmp_path):
    for name in os.listdir(small):
        if name != "customer.parquet":
            os.symlink(f"{small}/{name}", tmp_path / name)
    customers, counts = spark.read.parquet(f"{small}/customer.parquet"), []
    for rows in (customers, customers.filter("c_custkey % 2 = 0")):
        rows.write.mode("overwrite").parquet(f"{tmp_path}/customer.parquet")
        counts.append({r["table_name"]: r["actual_count"] for r in QUERIES["run_reconcile"](spark, str(tmp_path)).collect()})
    assert 0 < counts[1]["countries"] < counts[0]["countries"]
    books = {(r["step"], r["dataset"]): r["record_count"] for r in QUERIES["run_books"](spark, str(tmp_path)).collect()}
    assert books["load", "countries"] == counts[1]["countries"]


def test_dedup_across_files_writes_from_all_tasks(spark, small, tmp_path, monkeypatch):
    customers = spark.read.parquet(f"{small}/customer.parquet")
    customers.repartition(4).write.parquet(f"{tmp_path}/tables/customer.parquet")
    monkeypatch.setattr(catalog, "scratch", lambda spark: str(tmp_path / "work"))
    got = {(r["country"], r["cases"]) for r in QUERIES["dedup_across_files"](spark, str(tmp_path / "tables")).collect()}
    assert got == {(r["c_name"], r["c_custkey"] * (1 if r["c_custkey"] % 2 else 10)) for r in customers.collect()}
    assert all(len(list((tmp_path / "work" / name).glob("part-*"))) > 1 for name in ("c_20240501", "c_20240502"))


def test_a_load_may_be_repeated(spark, tmp_path):
    """The rows of a run replace those of the same run, on days it still has and days it has no more."""
    def rows(*given):
        return spark.createDataFrame([(k, None if d is None else dt.date(2024, 5, d), n) for k, d, n in given], "id string, snapshot_date date, n int")

    def held(name="again"):
        return sorted((r["id"], str(r["snapshot_date"]), r["n"], r["load_run"]) for r in spark.table(name).collect())

    day = ("snapshot_date",)
    writers.load_run(rows(("a", 1, 1), ("b", 2, 2), ("c", None, 3)), "again", "it's \\ x/1:00", day)
    first = held()
    assert first == [(k, d, n, "it's \\ x/1:00") for k, d, n in (("a", "2024-05-01", 1), ("b", "2024-05-02", 2), ("c", "None", 3))]
    writers.load_run(rows(("a", 1, 9), ("d", 4, 4)), "again", "two", day)
    writers.load_run(rows(("a", 1, 1), ("b", 2, 2), ("c", None, 3)), "again", "it's \\ x/1:00", day)
    other = [("a", "2024-05-01", 9, "two"), ("d", "2024-05-04", 4, "two")]
    assert held() == sorted(first + other)
    writers.load_run(rows(("a", 3, 7)), "again", "it's \\ x/1:00", day)
    assert held() == sorted([("a", "2024-05-03", 7, "it's \\ x/1:00")] + other)
    writers.load_run(rows(), "again", "it's \\ x/1:00", day)
    assert held() == other
    assert writers.drop_expired(spark, "again", 2, "2024-05-04") == ["2024-05-01"]
    writers.load_table(rows(("e", 4, 5)), "again")
    assert held() == [("d", "2024-05-04", 4, "two"), ("e", "2024-05-04", 5, None)]
    spark.sql("CREATE TABLE plainly (id string, n int) USING parquet")
    with pytest.raises(ValueError, match="load_run"):
        writers.load_run(rows(("a", 1, 1)), "plainly", "x")


def test_a_load_step_may_be_repeated(spark, landing, tmp_path):
    """Loading again under the same execution id changes nothing; a load that was cut off is made whole."""
    out, data = str(tmp_path), ("global", "countries", "continents", "states", "vaccines")
    runs.run_steps(spark, landing, out, NOW, skip=("load",), execution_id="x1", include_history=False)
    one = writers.read_bundle(spark, runs._manifest(spark, out, "processed", "x1"))["countries"]
    writers.load_tables({"countries": one.limit(1)}, "la_", run_id="x1")      # cut off within its first table
    counts = []
    for _ in range(2):
        result = runs.run_steps(spark, landing, out, NOW, step="load", execution_id="x1", prefix="la_")
        assert result["status"] == "success" and all(r["is_valid"] for r in result["reconcile"])
        counts.append({d: spark.table(f"la_{d}").count() for d in data})
    assert counts[0] == counts[1] and counts[0]["countries"] == 3


def test_digests_see_what_counts_do_not(spark):
    given = spark.sql("SELECT * FROM VALUES (1, 'a', CAST(NULL AS STRING), map('x', 1)), (2, CAST(NULL AS STRING), 'a', map('y', 2)), (3, 'c', 'd', NULL) AS t(g, p, q, m)")
    same = given.repartition(3).select("m", "q", "p", "g")
    assert all(r["content_match"] for r in writers.reconcile_content(same, given, ["g"]).collect())
    for change in ("if(g = 1, q, p) AS p, if(g = 1, p, q) AS q, m", "p, if(g = 3, 'e', q) AS q, m", "p, q, if(g = 2, map('y', 3), m) AS m"):
        row, = writers.reconcile_content(spark.sql(f"SELECT g, {change} FROM {{given}}", given=given), given).collect()
        assert (row["count_match"], row["content_match"]) == (True, False)
    missing = writers.reconcile_content(given.filter("g < 3"), given, ["g"]).filter("NOT count_match").collect()
    assert [(r["g"], r["expected_count"], r["actual_count"]) for r in missing] == [(3, 1, 0)]
