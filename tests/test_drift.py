"""Payloads that depart from their schema."""

import json
import uuid

import landing
from snapstats import catalog
from snapstats.sources import drift, readers


def _write(folder, document, name="a"):
    (folder / f"{name}.json").write_text(document if isinstance(document, str) else json.dumps(document))
    return str(folder)


def _found(docs, dataset):
    return {(r["field"], r["status"], r["type"]): r["documents"] for r in drift.drift(docs, dataset).collect()}


def test_unknown_renamed_and_retyped_fields_at_any_depth(spark, tmp_path):
    good = landing.country("Peru", 1)
    odd = landing.country("Chile", 2, cases="9", extraField={"a": [1]})
    odd["countryInfo"]["zip"] = odd["countryInfo"].pop("flag")
    odd["todayDeaths"] = 0.5
    docs = drift.documents(spark.read, _write(tmp_path, [good, odd]))
    assert _found(docs, "countries") == {
        ("extraField", "unknown", "object"): 1, ("cases", "retyped", "string"): 1, ("todayDeaths", "retyped", "decimal"): 1,
        ("countryInfo.zip", "unknown", "string"): 1, ("countryInfo.flag", "missing", None): 1}
    rows = {r["country"]: r["extras"] for r in drift.with_extras(docs, "countries").select("country", "extras").collect()}
    assert rows["Peru"] == {}
    assert {k: v.toPython() for k, v in rows["Chile"].items()} == {
        "extraField": {"a": [1]}, "cases": "9", "todayDeaths": rows["Chile"]["todayDeaths"].toPython(), "countryInfo.zip": "f.png"}


def test_typed_columns_are_those_of_the_plain_reader(spark, tmp_path):
    path = _write(tmp_path, landing.DOCUMENTS["countries"])
    plain = readers.read_snapshot(spark, path, "countries", "2024-05-01").drop("ingest_seq")
    kept = readers.from_payload(drift.with_extras(drift.documents(spark.read, path), "countries"), "countries", "2024-05-01")
    shared = [c for c in plain.columns if c in kept.columns]
    assert set(plain.columns) == set(shared) and set(kept.columns) == {*shared, "extras"}
    assert sorted(map(str, plain.select(shared).collect())) == sorted(map(str, kept.select(shared).collect()))


def test_nulls_scalars_and_broken_documents(spark, tmp_path):
    _write(tmp_path, [{"state": None, "cases": None}, 5, "text", None, {}], "a")
    _write(tmp_path, '{"state": ', "b")
    _write(tmp_path, "", "c")
    docs = drift.documents(spark.read, str(tmp_path))
    assert docs.count() == 2
    found = _found(docs, "states")
    assert {s for _, s, _ in found} == {"missing"} and found["state", "missing", None] == 1 and found["deaths", "missing", None] == 2


def test_documents_of_every_data_set(spark, tmp_path):
    """Only the continents' fixture has fields that no schema names."""
    landing.write(str(tmp_path / "l"))
    for dataset in landing.DOCUMENTS:
        found = _found(drift.documents(spark.read, f"{tmp_path}/l/{dataset}"), dataset)
        beyond = {"oneCasePerPeople", "oneDeathPerPeople", "oneTestPerPeople"} if dataset == "continents" else set()
        assert {field for field, status, _ in found if status != "missing"} == beyond


def test_streams_report_as_batches_do(spark, small):
    folder = catalog._drifting_landing(spark, small)
    name = f"d{uuid.uuid4().hex}"
    docs = drift.documents(spark.readStream, folder, lines=True)
    running = drift.drift(docs, "states").writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    running.awaitTermination()
    batch = drift.drift(drift.documents(spark.read, folder, lines=True), "states")
    assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, batch.collect()))
