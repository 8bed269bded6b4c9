"""Near-duplicate documents by min-max hashing, confirmed on whole shingle sets.

* Every permutation gives two values of a signature, the smallest and the largest hash, so half as many hashes
  are evaluated. Bands of the signature are as many as miss a pair at the threshold once in a million times.
* Documents with equal sets are one class; only classes go on. Each is tied to the smallest class of each of its
  bands; what hangs together is a cluster, and holds every candidate pair, without listing any.
* Within a cluster all pairs are compared on whole sets, in blocks: sets are dealt to groups of bounded size, each
  pair of groups is a task's work, which returns a spanning forest of the links it finds, never all of them.
"""

from __future__ import annotations

import hashlib
import math
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import blank_words, cut, ensure_checkpoint_dir, map_rows
from snapstats.llm.components import components

SHINGLE = 5
ROWS = 5
MISSED = 1e-6
#: Bytes of sets in a group; a task holds two groups.
GROUP_BYTES = 8 << 20
#: Sets compared at once, and shingles of them at once.
BLOCK, COLUMNS = 128, 8192

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; fewer words are one shingle, no words none."""
    words = blank_words(text)
    if not words:
        return np.empty(0, np.uint64)
    of = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(of))
    out = of[:len(of) - size + 1].copy()
    for k in range(1, size):
        out *= _PRIME
        out += of[k:len(of) - size + 1 + k]
    out += np.uint64(size)
    out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return np.unique(out)


def bands_for(percent: int) -> int:
    """Bands of ``ROWS`` values that miss a pair of this similarity with a chance of ``MISSED``."""
    return math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** ROWS))


def signatures(sets: list[np.ndarray], bands: int) -> list[list[int]]:
    """Band hashes of each set: minima and maxima under the permutations, five values to a band."""
    full = [k for k, s in enumerate(sets) if len(s)]
    out: list[list[int]] = [[] for _ in sets]
    if not full:
        return out
    permutations = math.ceil(bands * ROWS / 2)
    values = np.concatenate([sets[k] for k in full])
    starts = np.cumsum([0] + [len(sets[k]) for k in full[:-1]])
    rng = np.random.default_rng(7)
    factors = rng.integers(1, 1 << 63, permutations, np.uint64) * np.uint64(2) + np.uint64(1)
    signature = np.empty((2 * permutations, len(full)), np.uint64)
    for k, factor in enumerate(factors):
        moved = values * factor
        moved ^= moved >> np.uint64(31)
        signature[2 * k] = np.minimum.reduceat(moved, starts)
        signature[2 * k + 1] = np.maximum.reduceat(moved, starts)
    # A band takes values of different permutations: all minima first, then all maxima.
    signature = np.concatenate((signature[::2], signature[1::2]))[:bands * ROWS].reshape(bands, ROWS, len(full))
    hashed = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64)[:, None] * _MIX, (bands, len(full))).copy()
    for k in range(ROWS):
        hashed = (hashed ^ signature[:, k]) * _PRIME
        hashed ^= hashed >> np.uint64(29)
    for column, k in enumerate(full):
        out[k] = hashed[:, column].astype(np.int64).tolist()
    return out


class Forest:
    """Union-find over places; remembers the links that joined two trees."""

    def __init__(self, n: int):
        self.parent, self.links, self.trees = list(range(n)), [], n

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def link(self, a: int, b: int) -> None:
        x, y = self.root(a), self.root(b)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
            self.links.append((a, b))
            self.trees -= 1


def common(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``one`` with every set of ``two``."""
    out = np.zeros((len(one), len(two)), np.float32)
    words, place = np.unique(np.concatenate(one + two), return_inverse=True)
    row = np.repeat(np.arange(len(one) + len(two)), [len(s) for s in one + two])
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    cuts = np.searchsorted(place, np.arange(0, len(words) + COLUMNS, COLUMNS))
    for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            matrix = np.zeros((len(one) + len(two), COLUMNS), np.float32)
            matrix[row[a:b], place[a:b] - n * COLUMNS] = 1
            out += matrix[:len(one)] @ matrix[len(one):].T
    return out


def links(sets: list[np.ndarray], side: list[int], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the sets; of two sides only links across count.

    Sets are ordered by size, so blocks too different in size are not compared.
    """
    forest = Forest(len(sets))
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    blocks = [order[k:k + BLOCK] for k in range(0, len(order), BLOCK)]
    sizes = np.array([len(s) for s in sets], np.int64)
    across = len(set(side)) > 1
    for x, one in enumerate(blocks):
        for two in blocks[x:]:
            if 100 * sizes[one[-1]] < percent * sizes[two[0]]:
                break
            if forest.trees == 1:
                return forest.links
            if len({forest.root(k) for k in {*one, *two}}) == 1:
                continue
            both = common([sets[k] for k in one], [sets[k] for k in two]).astype(np.int64)
            union = sizes[one][:, None] + sizes[two][None, :] - both
            for a, b in np.argwhere(100 * both >= percent * union).tolist():
                if one[a] != two[b] and not (across and side[one[a]] == side[two[b]]):
                    forest.link(one[a], two[b])
    return forest.links


def stars(found: list[tuple[int, int]], ids: list) -> list[tuple[int, int]]:
    """Places of the same components as the links', each tied to the place of its smallest id; as many edges as a forest has."""
    ends = sorted({x for link in found for x in link}, key=ids.__getitem__)
    at = {place: n for n, place in enumerate(ends)}
    forest = Forest(len(ends))
    for a, b in found:
        forest.link(at[a], at[b])
    return [(ends[n], ends[root]) for n in range(len(ends)) if (root := forest.root(n)) != n]


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 85,
                    size: int = SHINGLE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, text_hash.

    Documents are linked when 100 * intersection >= ``percent`` * union of their sets of distinct shingles;
    component_id is the smallest doc_id reachable. Documents without words, or with a null text, are linked with
    nothing. Repeated rows of one doc_id are one document of the component and share ``kept``. A row without
    doc_id takes the component of its equal texts and is not kept there; if it has none, component_id is null and
    it is kept. Other columns are not touched.
    """
    kind, bands = dict(docs.dtypes)[key], bands_for(percent)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            sets = [shingles(x, size) for x in batch.column("text").to_pylist()]
            return {"key": batch.column("key"), "text_hash": batch.column("text_hash"), "n": [len(s) for s in sets],
                    "set": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    "bands": signatures(sets, bands)}

        return work

    hashed = cut(map_rows(rows, f"key {kind}, text_hash bigint, n bigint, set binary, bands array<bigint>", make))
    classes = hashed.where("set is not null and key is not null").groupBy("set").agg(F.min("key").alias("node"))
    # One row of each class, the one of its smallest id, brings its bands.
    banded = hashed.where("set is not null").join(classes.withColumnRenamed("node", "key"), ["set", "key"]) \
        .select(F.col("key").alias("node"), F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    ties = banded.join(hubs.select("band", "hub"), "band").where("node <> hub")
    clusters = cut(components(ties.select(F.col("hub").alias("a"), F.col("node").alias("b"))))
    linked = components(confirmed(rows, hashed, clusters, percent=percent, size=size, group_bytes=group_bytes))
    found = classes.join(linked.withColumnRenamed("component", "linked"), classes["node"] == linked["node"], "left") \
        .select("set", F.coalesce("linked", classes["node"]).alias("component"))
    return hashed.join(found, "set", "left").select(
        F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "key").alias("component_id"),
        F.coalesce(F.col("key") == F.coalesce("component", "key"), F.col("component").isNull()).alias("kept"), "text_hash")


def clean(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` would keep if every row had an id of its own: one of each group.

    Repeated rows, and rows without doc_id, are documents like others. The row of the smallest doc_id stays, of rows
    alike in that any one of them, a row without doc_id only where no other is in the group. Rows without words are
    linked with nothing and stay.
    """
    row = "row_id"
    while row in docs.columns:
        row += "_"
    # Numbers of rows hold only for one run over the rows, so they are stored before they are used, as small as they get: whoever
    # reads the result reads them, so they are on disk beside whatever comes next.
    ensure_checkpoint_dir(docs.sparkSession)
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    path = f"{docs.sparkSession.sparkContext.getCheckpointDir()}/rows-{uuid.uuid4()}"
    numbered.write.parquet(path, compression="zstd")
    numbered = docs.sparkSession.read.schema(numbered.schema).parquet(path)
    found = near_duplicates(numbered, key=row, text=text, percent=percent).select(F.col("doc_id").alias(row), "component_id")
    kept = found.join(numbered.select(row, F.col(key).alias("key")), row).groupBy("component_id").agg(
        F.min(F.struct(F.col("key").isNull().alias("none"), "key", row)).alias("first")).select(f"first.{row}")
    return numbered.join(kept, row, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))


def confirmed(rows: DataFrame, hashed: DataFrame, clusters: DataFrame, *, percent: int, size: int, group_bytes: int) -> DataFrame:
    """Edges (a, b) of a spanning forest of what is linked in every cluster, found on whole sets.

    A task gives what it finds linked as stars around the smallest id, so that clusters of one task are components as they are.
    """
    sizes = hashed.where("key is not null").groupBy("key").agg(F.max("n").alias("n"))
    members = clusters.join(sizes, clusters["node"] == sizes["key"]).select("component", "node", "n")
    groups = members.groupBy("component").agg(F.ceil(F.sum("n") * 8 / group_bytes).cast("int").alias("groups"))
    dealt = members.join(groups, "component").withColumn("own", F.pmod(F.hash("node"), F.col("groups")))
    texts = rows.join(dealt, rows["key"] == dealt["node"]).select("component", "node", "groups", "own", "text")

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            return {c: batch.column(c) for c in ("component", "node", "groups", "own")} | {
                "values": [shingles(x, size).tobytes() for x in batch.column("text").to_pylist()]}

        return work

    kind = dict(clusters.dtypes)["node"]
    sets = map_rows(texts, f"component {kind}, node {kind}, groups int, own int, values binary", make)
    # Every group meets every other one, and itself, under a key of their own.
    met = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))) \
        .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def compare(group: pa.Table) -> pa.Table:
        node, low, high = group.column("node"), group.column("low")[0].as_py(), group.column("high")[0].as_py()
        values = [np.frombuffer(x, np.uint64) for x in group.column("values").to_pylist()]
        side = [int(x != low) for x in group.column("own").to_pylist()]
        found = links(values, side if low != high else [0] * len(side), percent)
        ends = stars(found, node.to_pylist())
        return pa.table({"a": node.take(pa.array([x for x, _ in ends], pa.int64())),
                         "b": node.take(pa.array([x for _, x in ends], pa.int64()))})

    return met.select("component", "low", "high", "own", "node", "values").groupBy("component", "low", "high") \
        .applyInArrow(compare, f"a {kind}, b {kind}")
