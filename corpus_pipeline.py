"""Documents to packed training sequences: a fixed chain of stages, each written and read again."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.llm import decontaminate, language, minhash, packing, substrings
from snapstats.llm.common import ensure_checkpoint_dir, ready, table

TOKENIZER = "word_bpe_49k.json"
#: Repeated strings of so many bytes go, but for their first places: shorter than nearly all passages of 50 words.
REPEATED_BYTES = 256
#: Fewer new bytes beside a copy are an edge of it, not a passage that has to stay in one piece.
OWN_BYTES = 64

# Each stage hands on the rows it keeps with all columns of documents. Rows that repeat are rows of their own, columns that a stage
# does not name are handed through, texts are read whole, and an empty table stays empty.


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier names by more than a narrow margin; a missing label is filled in.

    Null and empty texts, texts without a letter, ties and margins below 1 % are rejected. Without any label all rows are.
    """
    model = language.fit(docs, key="doc_id", text="text", lang="lang")
    found = language.predict(docs, model).where("not rejected")
    return found.select(*(F.coalesce("lang", "lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`") for c in docs.columns))


def near_unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of a similarity of 0.8 or more: the one with the smallest id.

    Rows that repeat, share an id or have none are told apart. Null and empty texts are in no group and stay.
    """
    return minhash.clean(docs, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without strings of 256 bytes that also start before: in a smaller id, or earlier in the text.

    Each repeated passage stays at its first place, so no content is lost to the corpus; one that brings fewer than 64 bytes besides
    what starts before holds back no copy (it may be a copy with a blank beside it), and only these bytes stay. Ties of ids go by the hash
    of the text; a null id is the smallest. Null and empty texts stay as they are; no row goes; n_chars is counted anew.
    """
    return substrings.clean(docs, length=REPEATED_BYTES, keep_first=True, own=OWN_BYTES)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth are passages of the benchmark.

    Null and empty texts, and those without a word, are not contaminated; all rows stay with an empty benchmark.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, and their places in sequences of 2048 tokens.

    A null text is empty; an empty one is a piece of its end mark alone. Workers forget a task's words: they stay for later work.
    """
    return packing.pack(packing.pieces(docs, public_tokenizers.path(TOKENIZER), remember=False))


def _stage(work):
    return lambda spark, docs, sf_dir: work(ready(spark), docs, sf_dir)


STAGES = [(f.__name__, _stage(f)) for f in (known_language, near_unique, without_repeats, decontaminated, packed)]

#: A compression classifier and a packing search are beyond SQL; tests/llm compares the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the table of documents; what each leaves is stored in the shared folder for the next."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{n}-{name}")
            docs = spark.read.parquet(f"{folder}/{n}-{name}")
    return docs
