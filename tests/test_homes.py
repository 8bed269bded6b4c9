"""Upserts that look up where keys live, against those that scan for it."""

import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from snapstats import catalog
from snapstats.sources import homes, writers

COLUMNS = "id STRING, n INT, snapshot_date DATE"


def _rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def _day(n):
    return dt.date(2024, 5, n)


def _table(spark, folder, rows, folders=4):
    path = writers.write_dataset(spark.createDataFrame(rows, COLUMNS), f"{folder}/t", partition_by=("snapshot_date",))
    homes.build(spark.read.parquet(path), f"{folder}/homes", ["id"], folders=folders)
    return path, f"{folder}/homes"


def _places(spark, side):
    return _rows(spark.read.parquet(side).select("id", "snapshot_date"))


def test_same_as_scanning(spark, small, tmp_path):
    stored, batches = catalog._order_batches(spark, small)
    paths = [writers.write_dataset(stored, f"{tmp_path}/{n}", partition_by=("snapshot_date",)) for n in "ab"]
    side = f"{tmp_path}/homes"
    homes.build(spark.read.parquet(paths[0]), side, ["o_orderkey"], folders=8)
    for batch in batches:
        touched = homes.upsert(spark, paths[0], side, batch, ["o_orderkey"], [])
        assert set(touched) == set(writers.upsert_table(spark, paths[1], batch, ["o_orderkey"], []))
        now = [spark.read.parquet(p).select("o_orderkey", "snapshot_date", "o_totalprice") for p in paths]
        assert _rows(now[0]) == _rows(now[1])
        assert _rows(spark.read.parquet(side).select("o_orderkey", "snapshot_date")) == _rows(now[0].drop("o_totalprice"))


def test_null_keys_null_days_and_repeats(spark, tmp_path):
    path, side = _table(spark, tmp_path, [("a", 1, _day(1)), (None, 2, None), ("b", 3, _day(2))])
    batch = spark.createDataFrame([(None, 20, _day(3)), ("a", 10, None), ("a", 10, None), ("c", 5, _day(1))], COLUMNS)
    assert set(homes.upsert(spark, path, side, batch, ["id"], ["n"])) == {None, _day(1), _day(3)}
    want = sorted(map(str, [("a", 10, None), (None, 20, _day(3)), ("b", 3, _day(2)), ("c", 5, _day(1))]))
    assert _rows(spark.read.parquet(path).select("id", "n", "snapshot_date")) == want
    assert _places(spark, side) == sorted(map(str, [("a", None), (None, _day(3)), ("b", _day(2)), ("c", _day(1))]))
    assert homes.upsert(spark, path, side, batch.limit(0), ["id"], ["n"]) == []
    assert _rows(spark.read.parquet(path).select("id", "n", "snapshot_date")) == want


def test_only_folders_of_the_batch_are_read_and_written(spark, tmp_path):
    path, side = _table(spark, tmp_path, [(f"k{i}", i, _day(1 + i % 3)) for i in range(60)], folders=16)
    batch = spark.createDataFrame([("k7", 700, _day(2))], COLUMNS)
    found = homes.find(spark, side, batch, ["id"])
    assert [tuple(r) for r in found.collect()] == [("k7", _day(2))]
    assert path not in found._jdf.queryExecution().toString()      # the table itself is not looked at
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    before = set(glob.glob(f"{side}/of=16/bucket=*/*.parquet"))
    homes.upsert(spark, path, side, batch, ["id"], [])
    after = set(glob.glob(f"{side}/of=16/bucket=*/*.parquet"))
    assert len({f.rsplit("/", 1)[0] for f in before ^ after}) == 1
    assert {f.rsplit("/", 2)[1] for f in glob.glob(f"{path}/*/*.parquet")} == {f"snapshot_date={_day(n)}" for n in (1, 2, 3)}


@pytest.mark.parametrize("step", ["merge", "tidy"])
def test_a_cut_off_upsert_may_be_repeated(spark, tmp_path, monkeypatch, step):
    path, side = _table(spark, tmp_path, [("a", 1, _day(1)), ("b", 2, _day(1))])
    batch = spark.createDataFrame([("a", 10, _day(2)), ("c", 3, _day(4))], COLUMNS)

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(*((writers, "merge_partitions") if step == "merge" else (homes, "_left")), lost)
        with pytest.raises(RuntimeError):
            homes.upsert(spark, path, side, batch, ["id"], [])
    places = set(_places(spark, side))
    assert {str(tuple(r)) for r in spark.read.parquet(path).select("id", "snapshot_date").collect()} <= places
    homes.upsert(spark, path, side, batch, ["id"], [])
    stored = spark.read.parquet(path)
    assert _rows(stored.select("id", "n", "snapshot_date")) == sorted(map(str, [
        ("a", 10, _day(2)), ("b", 2, _day(1)), ("c", 3, _day(4))]))
    assert _places(spark, side) == _rows(stored.select("id", "snapshot_date"))


def test_keys_of_another_type_are_found(spark, tmp_path):
    rows = spark.range(20).select("id", F.lit(_day(1)).alias("snapshot_date"))
    path = writers.write_dataset(rows, f"{tmp_path}/t", partition_by=("snapshot_date",))
    homes.build(spark.read.parquet(path), f"{tmp_path}/homes", ["id"], folders=8)
    batch = rows.filter("id < 5").select(F.col("id").cast("int").alias("id"), F.lit(_day(2)).alias("snapshot_date"))
    homes.upsert(spark, path, f"{tmp_path}/homes", batch, ["id"], [])
    assert spark.read.parquet(path).groupBy("snapshot_date").count().orderBy("snapshot_date").collect() == [
        (_day(1), 15), (_day(2), 5)]


def test_a_new_table(spark, tmp_path):
    empty = spark.createDataFrame([], COLUMNS)
    path, side = f"{tmp_path}/t", f"{tmp_path}/homes"
    spark.createDataFrame([("z", 0, _day(1))], COLUMNS).write.partitionBy("snapshot_date").parquet(path)
    homes.build(empty, side, ["id"])
    assert homes.find(spark, side, empty.union(spark.createDataFrame([("a", 1, _day(1))], COLUMNS)), ["id"]).count() == 0
    homes.upsert(spark, path, side, spark.createDataFrame([("a", 1, _day(1))], COLUMNS), ["id"], [])
    assert _places(spark, side) == [str(("a", _day(1)))]
