"""Helpers shared by the operators: tables, word rules, Arrow batches."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Rows handed to Python at once: texts can be long, so few rows.
BATCH_ROWS = 256


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context: they need not share the driver's folders."""
    context = spark.sparkContext
    if hasattr(context, "_snapstats_sent"):
        return
    top = Path(__file__).resolve().parents[1]
    context._snapstats_sent = folder = tempfile.TemporaryDirectory()  # kept as long as the context
    packed = Path(folder.name, "snapstats_package.zip")
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    context.addPyFile(str(packed))


def ready(spark: SparkSession) -> SparkSession:
    """Executors have the package, and batches that reach Python stay small."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data set."""
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; a folder of our own only where none is named (tests)."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="run-checkpoint-")
        context.setCheckpointDir(folder)


def cut(df: DataFrame) -> DataFrame:
    """Store a small intermediate result in the shared folder and go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def map_rows(df: DataFrame, schema: str | StructType,
             make: Callable[[], Callable[[pa.RecordBatch], dict[str, list | pa.Array] | Iterator[dict[str, list | pa.Array]]]],
             done: Callable[[], None] = lambda: None) -> DataFrame:
    """``mapInArrow`` with a function from a batch to columns, or to columns of several batches; ``make`` runs once a task, ``done`` at its end.

    A Python worker outlives its task and stands beside those of later stages, so it gives back what it no longer uses.
    """
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    types = to_arrow_schema(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            made = work(batch)
            for columns in [made] if isinstance(made, dict) else made:
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in types], names=types.names)
        work = batch = made = columns = None
        done()
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, wanted)


def beside(docs: DataFrame, *used: str) -> F.Column:
    """The columns that an operator does not use itself, in one struct that it hands through."""
    rest = [c for c in docs.columns if c not in used]
    return F.struct(*(F.col(f"`{c}`") for c in rest)) if rest else F.struct(F.lit(None).cast("string").alias("none"))


def kind_of(docs: DataFrame, column: F.Column) -> str:
    return docs.select(column).schema[0].dataType.simpleString()


# ASCII letters and digits stay (letters folded), other ASCII parts words, the rest of Unicode is kept.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD_IN_TEXT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def alnum_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased, as UTF-8."""
    return [] if text is None else text.encode().translate(_ALNUM).split()


def blank_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8."""
    return [] if text is None else text.encode().translate(_LOWER).split()


def runs(flags) -> list[tuple[int, int]]:
    """Half-open runs of true values of a boolean array."""
    import numpy as np

    edges = np.flatnonzero(np.diff(np.concatenate(([0], np.asarray(flags, np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


