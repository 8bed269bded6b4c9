"""Ranked lexical search: one automaton of all items' terms scans the documents; there is no index of them.

The automaton holds every term between boundaries. It runs over a text whose other characters are blanks, so that what it
finds are occurrences of terms, and its outputs are numbers of terms, which lead to the items that hold them.

Two scans: the first adds up, for each task, how many documents hold each term; the second weighs the occurrences of each
document and keeps, for each item and task, the best documents so far. Documents are not shuffled.
Items are a stated query set: beyond ``BLOCK_CHARS`` of text they are taken in blocks, one after the other.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstats.llm.common import _ALNUM, alnum_words, cut

TOP = 50
#: Text of the items in a block; an automaton takes some hundred bytes for each character, in every Python worker.
BLOCK_CHARS = 1 << 20
#: Parts that the tasks' best documents of an item are dealt over before they meet.
PARTS = 64

_LAST = -math.inf  # the place of a document without id among equals
_automata: dict = {}


def spaced(text: str | None) -> tuple[str, int]:
    """The text in lower case with a blank for every character that is in no term, and around it; how many terms it has."""
    plain = text.encode().translate(_ALNUM) if text else b""
    return f" {plain.decode()} ", len(plain.split())


def terms_of(texts) -> list[str]:
    """Distinct terms of an item's texts."""
    return sorted({w.decode() for text in texts for w in alnum_words(text)})


def automaton(terms: list[str]):
    """Every term between blanks; its number is the output."""
    import ahocorasick

    out = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(terms):
        out.add_word(f" {term} ", number)
    if terms:
        out.make_automaton()
    return out


def _machine(digest: str, terms: list[str]):
    """One automaton in each Python worker, built once."""
    if digest not in _automata:
        _automata.clear()
        _automata[digest] = automaton(terms)
    return _automata[digest]


def occurrences(machine, text: str) -> Counter:
    """{term number: occurrences} in a spaced text; neighbouring terms share the blank between them."""
    return Counter(map(itemgetter(1), machine.iter(text))) if len(machine) else Counter()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def scored(found: Counter, n: int, n_docs: int, n_terms: int, weights: np.ndarray, first: np.ndarray, owners: np.ndarray, items: int) -> np.ndarray:
    """Scores of all items for a document of ``n`` terms; the items of term t are owners[first[t]:first[t + 1]]."""
    ids = np.fromiter(found.keys(), np.int64, len(found))
    tf = np.fromiter(found.values(), np.int64, len(found))
    m = 100 - 50 + (50 * n * n_docs) // n_terms
    value = weights[ids] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
    many = first[ids + 1] - first[ids]
    at = np.repeat(first[ids] - np.cumsum(many) + many, many) + np.arange(many.sum())
    out = np.zeros(items, np.int64)
    np.add.at(out, owners[at], np.repeat(value, many))
    return out


def _place(doc: int | None) -> float:
    """Among equal scores the greatest place is first: the smallest id, and none last."""
    return _LAST if doc is None else -doc


def statistics(rows: DataFrame, shared) -> DataFrame:
    """(term, n): sums over tasks; term -1 are documents with a term, -2 all terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, terms = shared.value
        machine, held, known = _machine(digest, terms), Counter(), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                body, n = spaced(text)
                if n:
                    known[-1] += 1
                    known[-2] += n
                    held.update(set(map(itemgetter(1), machine.iter(body))) if len(machine) else ())
        held.update(known)
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.int64())], names=["term", "n"])

    return rows.mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


def _best(rows: DataFrame, shared, ranking, top: int) -> DataFrame:
    """(item number, doc_id, score): for each task its first ``top`` documents of each item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, terms = shared.value
        n_docs, n_terms, weights, first, owners, items = ranking.value
        machine = _machine(digest, terms)
        heaps: list[list] = [[] for _ in range(items)]
        least = np.ones(items, np.int64)  # a score has to reach it
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                body, n = spaced(text)
                found = occurrences(machine, body)
                if not found:
                    continue
                scores = scored(found, n, n_docs, n_terms, weights, first, owners, items)
                for item in np.flatnonzero(scores >= least).tolist():
                    heap, entry = heaps[item], (int(scores[item]), _place(doc))
                    if len(heap) < top:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heappushpop(heap, entry)
                    if len(heap) == top:
                        least[item] = heap[0][0]
        for item in range(0, items, 64):  # a few items a batch
            out = [(k, None if place == _LAST else -place, score) for k in range(item, min(item + 64, items)) for score, place in heaps[k]]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return rows.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _block(docs: DataFrame, items: list[tuple], top: int) -> DataFrame:
    """(number of the item, rank, doc_id, score) for one block of (item, its terms)."""
    spark = docs.sparkSession
    terms = sorted({t for _, own in items for t in own})
    number = {t: k for k, t in enumerate(terms)}
    shared = spark.sparkContext.broadcast((hashlib.sha256("\n".join(terms).encode()).hexdigest(), terms))
    counts = {r["term"]: r["n"] for r in statistics(docs, shared).collect()}  # as many rows as the block has terms, and two
    n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
    weights = np.array([weight(n_docs, counts.get(k, 0)) for k in range(len(terms))], np.int64)
    held: list[list[int]] = [[] for _ in terms]
    for at, (_, own) in enumerate(items):
        for t in own:
            held[number[t]].append(at)
    first = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int64)
    owners = np.array([at for x in held for at in x], np.int64)
    ranking = spark.sparkContext.broadcast((n_docs, n_terms, weights, first, owners, len(items)))
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    best = _best(docs, shared, ranking, top).withColumn("part", F.spark_partition_id() % PARTS)
    for keys in (("item", "part"), ("item",)):  # the tasks' candidates of an item never meet in one task all at once
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return best.select("item", "rank", "doc_id", "score")


def search(docs: DataFrame, benchmark: DataFrame, *, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
           top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item, of those with a score above 0.

    Terms are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. Ids of documents are integers; among equal
    scores the smaller id comes first, and documents without id come last. A null or empty text has no terms and is
    no document for the statistics; rows that repeat are documents of their own. Rows of one item id are one item with
    the terms of all of them; rows without id are such an item, too. An item without terms, or an empty table, has no result.
    Other columns are not read.
    """
    spark = docs.sparkSession
    kind = dict(benchmark.dtypes)[item]
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    given = benchmark.select(F.col(item).alias("item"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    size = given.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_chars))
    results = []
    for n in range(blocks):
        texts: dict = {}
        for r in given.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == n).toLocalIterator():
            texts.setdefault(r["item"], []).append(r["text"])
        items = [(who, terms_of(own)) for who, own in texts.items()]
        if any(own for _, own in items):
            names = spark.createDataFrame([(k, who) for k, (who, _) in enumerate(items)], f"item bigint, item_id {kind}")
            found = _block(rows, items, top).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
            results.append(cut(found) if blocks > 1 else found)
    if not results:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    return reduce(DataFrame.unionByName, results)
