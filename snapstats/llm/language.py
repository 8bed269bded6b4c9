"""Language ID by compression: the language whose text helps most to compress a text.

One raw-content zstandard dictionary per language, cut from a bounded sample of labelled texts. Only letters
in lower case count. A text is encoded in blocks, so that what it says about its language does not drown in
its own repetitions; the language with the smallest total wins. A narrow margin over the runner-up rejects the answer.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapstats.llm.common import map_rows

#: The training sample: texts per language, characters of each, bytes of dictionary per language.
SAMPLE_TEXTS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 800, 1 << 16
#: All dictionaries together; beyond it, the caller must merge labels.
MODEL_BYTES = 64 << 20
BLOCK = 4096
#: Short matches matter: words of related languages differ in a few letters.
LEVEL, MIN_MATCH = 5, 3
#: Smallest share by which the runner-up must be larger.
MARGIN = 0.01
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_OTHER = re.compile(r"[\W\d_]+")
_models: dict = {}


def fit(labelled: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """Dictionaries from rows that have a text and a label: pieces of the texts with the smallest hashes of key and text.

    Labels are counted first, and of a frequent one only rows with hashes so small that about twice ``SAMPLE_TEXTS`` of them are left
    go on; so no task gets more for a language, however many rows or tasks there are. A piece is ``SAMPLE_CHARS`` characters from
    a place that the hash names, or the whole of a shorter text. Empty without labelled rows.
    """
    spark = labelled.sparkSession
    rows = labelled.select(F.col(lang).alias("lang"), F.shiftrightunsigned(F.xxhash64(key, text), 2).alias("place"), F.col(text).alias("text")) \
        .where("lang is not null and text is not null")
    limit = MODEL_BYTES // DICTIONARY_BYTES
    counts = [(r["lang"], r["count"]) for r in rows.groupBy("lang").count().limit(limit + 1).collect()]
    if len(counts) > limit:
        raise ValueError("too many languages for one model")
    if not counts:
        return {}
    # Of 2^62 parts of the hashes, those for twice the wanted rows; not so many rows are all taken.
    below = spark.createDataFrame([(name, (1 << 62) // n * min(n, 2 * SAMPLE_TEXTS)) for name, n in counts], "lang string, below bigint")
    start = F.pmod("place", F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int")
    piece = F.substring("text", start + 1, F.lit(SAMPLE_CHARS))
    likely = rows.join(F.broadcast(below), "lang").where(F.expr(f"place < below or below > {(1 << 62) - (1 << 44)}")) \
        .select("lang", "place", piece.alias("text"))
    first = likely.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))).where(f"n <= {SAMPLE_TEXTS}")
    model: dict[str, bytes] = {}
    for row in first.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("n", "text"))).alias("texts")).toLocalIterator():
        model[row["lang"]] = letters(" ".join(x["text"] for x in row["texts"]))[:DICTIONARY_BYTES]
    return dict(sorted(model.items()))


def letters(text: str) -> bytes:
    return _OTHER.sub(" ", text.lower()).encode()


def sizes_of(compressors: list, data: bytes) -> list[int]:
    """Compressed size of the data under each dictionary, in blocks."""
    parts = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
    return [sum(len(c.compress(p)) for p in parts) for c in compressors]


def _compressors(model: dict[str, bytes]) -> list:
    import zstandard

    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=MIN_MATCH, write_content_size=False, write_dict_id=False)
    out = []
    for content in model.values():
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(compression_params=settings)
        out.append(zstandard.ZstdCompressor(dict_data=known, compression_params=settings))
    return out


def classify(model: dict[str, bytes], compressors: list, text: str | None) -> tuple[str, float]:
    """(language, score): the score is the share of the runner-up's size that the best language saves, times 4."""
    if text is None or not model or not _LETTER.search(text):
        return UNKNOWN, 0.0
    if len(model) == 1:
        return next(iter(model)), 1.0
    ranked = sorted(zip(sizes_of(compressors, letters(text)), model, strict=True))
    return ranked[0][1], min(1.0, 4 * (1 - ranked[0][0] / ranked[1][0]))


def predict(docs: DataFrame, model: dict[str, bytes], *, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected; columns of these names are replaced.

    A null text or one without a letter is ``und`` with score 0 and rejected; so is every text without a
    model. Ties go to the first language by name, with score 0, and are rejected like any narrow margin.
    Texts are read whole.
    """
    names = ("lang_pred", "score", "rejected")
    rest = [c for c in docs.columns if c not in names]
    shared = docs.sparkSession.sparkContext.broadcast(
        (hashlib.sha256(repr(model).encode()).hexdigest(), model))
    schema = docs.select([F.col(f"`{c}`") for c in rest]).schema

    def make():
        digest, known = shared.value
        if digest not in _models:
            _models.clear()
            _models[digest] = _compressors(known)
        compressors = _models[digest]

        def work(batch: pa.RecordBatch) -> dict:
            found = [classify(known, compressors, x) for x in batch.column(text).to_pylist()]
            return {c: batch.column(c) for c in rest} | {
                "lang_pred": [x[0] for x in found], "score": [x[1] for x in found],
                "rejected": [x[0] == UNKNOWN or x[1] < 4 * margin for x in found]}

        return work

    wanted = StructType([*schema.fields, *StructType.fromDDL("lang_pred string, score double, rejected boolean").fields])
    return map_rows(docs.select([F.col(f"`{c}`") for c in rest]), wanted, make)
