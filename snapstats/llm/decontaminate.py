"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

The letters of the automaton are words (numbered by the items' vocabulary), so a document is
scanned once, word by word, and every match gives word positions; these are mapped back to
character offsets of the original text, which differ from it only in the case of ASCII letters.

The benchmark is a stated query set. Its size is measured first; it is cut into blocks of
``block_bytes`` of item text at most on average, and the blocks' automata follow one another in one chain of
maps, each adding to the hits found so far. Documents are never shuffled.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import WORD_IN_TEXT, alnum_words, beside, kind_of, map_rows, runs

WINDOW = 13
#: Item text per automaton: about a hundred bytes of automaton for each byte, in every Python worker.
BLOCK_BYTES = 1 << 20

_HITS = "hits array<struct<start:int,end:int>>, items array<string>"
_automata: dict = {}


def build(items: list[tuple[str | None, str | None]], window: int):
    """(vocabulary, automaton): its values are (window length, ids of the items that have the window)."""
    import ahocorasick

    vocabulary: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set] = defaultdict(set)
    for item, text in items:
        ids = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in alnum_words(text)]
        size = min(window, len(ids))
        for at in range(len(ids) - size + 1 if ids else 0):
            owners[tuple(ids[at:at + size])].add(item)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, ids in owners.items():
        automaton.add_word(key, (len(key), sorted(x for x in ids if x is not None)))
    if owners:
        automaton.make_automaton()
    return vocabulary, automaton if owners else None


def _built(shared, window: int):
    """The automaton of a broadcast block, built once for each Python worker; one is kept."""
    key = (shared.value[0], window)
    if key not in _automata:
        _automata.clear()
        _automata[key] = build(shared.value[1], window)
    return _automata[key]


def _scan(shared, window: int):
    def make():
        vocabulary, automaton = _built(shared, window)

        def work(batch: pa.RecordBatch) -> dict:
            hits, items = batch.column("hits").to_pylist(), batch.column("items").to_pylist()
            if automaton is not None:
                for row, text in enumerate(batch.column("text").to_pylist()):
                    ids = tuple(map(vocabulary.get, words := alnum_words(text), [0] * len(words)))
                    if not any(ids):
                        continue
                    found, owners = None, set()
                    for end, (size, who) in automaton.iter(ids):
                        if found is None:
                            found = np.zeros(len(ids), bool)
                        found[end - size + 1:end + 1] = True
                        owners.update(who)
                    if found is not None:
                        for old in hits[row]:
                            found[old["start"]:old["end"]] = True
                        hits[row] = [{"start": a, "end": b} for a, b in runs(found)]
                        items[row] = sorted(owners.union(items[row]))
            return {c: batch.column(c) for c in ("key", "text", "rest")} | {"hits": hits, "items": items}

        return work

    return make


def _finish():
    def work(batch: pa.RecordBatch) -> dict:
        out = {k: [] for k in ("n_words", "n_hit", "n_items", "items_sha256", "spans")}
        for text, hits, items in zip(*(batch.column(c).to_pylist() for c in ("text", "hits", "items")), strict=True):
            out["n_words"].append(len(alnum_words(text)))
            out["n_hit"].append(sum(x["end"] - x["start"] for x in hits))
            out["n_items"].append(len(items))
            out["items_sha256"].append(hashlib.sha256(",".join(items).encode()).hexdigest())
            at = [m.span() for m in WORD_IN_TEXT.finditer(text)] if hits else []
            out["spans"].append([{"start": at[x["start"]][0], "end": at[x["end"] - 1][1]} for x in hits])
        return out | {"doc_id": batch.column("key"), "items": batch.column("items"), "text": batch.column("text"), "rest": batch.column("rest")}

    return work


def find(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, items (ids as sorted
    strings), spans (character offsets of hit passages in the original text), contaminated.

    A null or wordless text has no words, no hits and is not contaminated. Items without words never match;
    windows of an item without id count as hits but name no item. Repeated rows are judged one by one; other
    columns of either table are not touched. With an empty benchmark nothing is hit. Options: those of ``_found``.
    """
    return _found(docs, benchmark, **options).drop("text", "rest")


def clean(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are; rules as in ``find``."""
    found = _found(docs, benchmark, key=key, text=text, **options).where("not contaminated")
    back = {key: "doc_id", text: "text"}
    return found.select(*(F.col(back[c]).alias(c) if c in back else F.col(f"rest.`{c}`") for c in docs.columns))


def _found(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("text")) \
        .where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    kind, rest = dict(docs.dtypes)[key], beside(docs, key, text)
    rest_kind = kind_of(docs, rest)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), rest.alias("rest"),
                       F.expr("cast(array() as array<struct<start:int,end:int>>) as hits"),
                       F.expr("cast(array() as array<string>) as items"))
    for n in range(blocks):
        part = [(r["item"], r["text"]) for r in items.where(block == n).collect()]
        digest = hashlib.sha256(repr(sorted(part, key=repr)).encode()).hexdigest()
        shared = spark.sparkContext.broadcast((digest, part))
        rows = map_rows(rows, f"key {kind}, text string, rest {rest_kind}, {_HITS}", _scan(shared, window))
    return map_rows(
        rows, f"doc_id {kind}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
        f"items array<string>, spans array<struct<start:int,end:int>>, text string, rest {rest_kind}", lambda: _finish()) \
        .withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))
