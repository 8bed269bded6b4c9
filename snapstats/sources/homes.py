"""A side table of where keys live, kept by the upsert itself.

An upsert has to know which partitions hold the keys of a batch. Here that is a table of its own: key columns and the partition
value, cut by a hash of the key into folders (``of=<folders>/bucket=<n>``). A batch reads the folders its keys fall into, and nothing
of the table but the partitions it rewrites.

The side table always names at least the places where a key is: places of a batch are added before the table changes, places that keys
have left are taken out after. A place too many costs the rewriting of one partition; a place too few would leave a key twice. So an
upsert that was cut off between its steps may be repeated. A driver lost while folders are being replaced may leave one missing:
``build`` makes the side table anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from snapstats import schemas as S
from snapstats.session import ensure_checkpoint_dir
from snapstats.sources import writers

FOLDERS = 64      # of a new side table; choose some 100 MB of keys a folder
_OF, _BUCKET = "of", "bucket"


def build(table: DataFrame, homes: str, keys, partition: str = S.PARTITION_COLUMN, folders: int = FOLDERS) -> None:
    """Write the side table of a stored table, from its key columns; in place of an earlier one.

    Null keys and null partitions are values like others.
    """
    places = table.select(*keys, partition).distinct()
    _placed(places, keys, folders).repartition(_BUCKET).write.mode("overwrite").partitionBy(_OF, _BUCKET).parquet(homes)


def find(spark: SparkSession, homes: str, batch: DataFrame, keys, partition: str = S.PARTITION_COLUMN) -> DataFrame:
    """Places (keys and partition) of those keys of a batch that are stored; other folders of the side table are not read."""
    side, wanted, _ = _opened(spark, homes, batch, keys, partition)
    return side.join(_aside(wanted, keys), _same(keys), "left_semi")


def upsert(spark: SparkSession, path: str, homes: str, new: DataFrame, keys, order, partition: str = S.PARTITION_COLUMN) -> list:
    """``writers.upsert_table`` with the partitions of the batch's keys looked up in their side table.

    The batch is checkpointed, so that lookup, side table and merge see the same rows. One upsert of a table at a time. Returns
    the touched partitions.
    """
    ensure_checkpoint_dir(spark)
    types = spark.read.parquet(path).schema      # a key of another type would fall into another folder
    new = new.withColumns({k: F.col(f"`{k}`").cast(types[k].dataType) for k in keys}).checkpoint()
    side, wanted, folders = _opened(spark, homes, new, keys, partition)
    side = side.checkpoint()      # its folders are replaced below
    of_batch = _aside(wanted, keys)
    old, others = (side.join(of_batch, _same(keys), how) for how in ("left_semi", "left_anti"))
    noted = old.unionByName(new.select(*keys, partition)).distinct()
    _replace(others.unionByName(noted), homes, keys, folders)
    touched = [r[0] for r in noted.select(partition).distinct().collect()]      # one value per day
    merged = writers.merge_partitions(spark, path, new, touched, keys, order, partition)
    now = merged.join(of_batch, _same(keys), "left_semi").select(*keys, partition)
    if _left(noted, now):
        _replace(others.unionByName(now), homes, keys, folders)
    return touched


def _left(noted: DataFrame, now: DataFrame) -> bool:
    """Whether some place that was noted before the merge holds its key no more."""
    return bool(noted.join(_aside(now, now.columns), _same(now.columns), "left_anti").limit(1).count())


def _replace(places: DataFrame, homes: str, keys, folders: int) -> None:
    """Write the folders that ``places`` fall into; no other is touched."""
    (_placed(places, keys, folders).repartition(_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(_OF, _BUCKET).parquet(homes))


def _opened(spark: SparkSession, homes: str, batch: DataFrame, keys, partition: str) -> tuple[DataFrame, DataFrame, int]:
    """Places in the folders that a batch's keys fall into, these keys, and the number of folders (an empty table has none yet)."""
    types = ", ".join(f"`{c}` {batch.schema[c].dataType.simpleString()}" for c in (*keys, partition))
    stored = spark.read.schema(f"{types}, {_OF} INT, {_BUCKET} INT").parquet(homes)
    first = stored.select(_OF).first()
    folders = first[0] if first else FOLDERS
    wanted = batch.select(*keys).distinct()
    hit = [r[0] for r in wanted.select(_bucket(keys, folders)).distinct().collect()]      # as many as there are folders
    return stored.filter(F.col(_BUCKET).isin(hit)).select(*keys, partition), wanted, folders


def _placed(places: DataFrame, keys, folders: int) -> DataFrame:
    return places.withColumns({_OF: F.lit(folders), _BUCKET: _bucket(keys, folders)})


def _bucket(keys, folders: int) -> Column:
    return F.pmod(F.hash(*[F.col(f"`{k}`") for k in keys]), F.lit(folders))


def _aside(df: DataFrame, columns) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in columns])


def _same(columns) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`")) for c in columns])
