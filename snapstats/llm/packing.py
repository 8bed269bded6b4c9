"""Best-fit packing of tokenized documents by a grouping genetic algorithm on islands.

Documents are tokenized once; the piece table (no text, no ids) is stored and packed:

* Pieces are dealt into shards of some ``SHARD`` pieces by a hash. Several islands evolve every shard with
  seeds of their own: an individual is a grouping of the shard's pieces into sequences, crossover injects
  whole well-filled sequences of one parent into the other, removes the sequences that hold the same pieces, and
  best-fits the displaced ones. After each epoch the best grouping of an island migrates to the next one.
* The best grouping's well-filled sequences are final. The pieces of the others move on to the next level,
  whose shards are so many times fewer, until one shard holds them all. So a shard costs about one open
  sequence, and all shards together only the last one.
"""

from __future__ import annotations

import math
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import cut, map_rows

CAPACITY = 2048
SHARD = 4096
ISLANDS, EPOCHS, POPULATION, GENERATIONS = 2, 2, 4, 6
#: A sequence filled to this share is final; others are opened again on the next level, where the gap that is
#: allowed is four times as large, so that every sequence is final on the fifth level at the latest.
WELL_FILLED = 0.995
#: Words, and parts of words, whose ids are remembered in a Python worker, and the longest such word.
CACHE_WORDS, CACHE_PARTS, CACHE_CHARS = 900_000, 400_000, 64

# White space that Python splits at, but for which the tokenizer's rule is not relied on.
_ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_PLAIN_SPACE = re.compile("[ \t\n\r]+")
# Words of Latin letters in one code point and common marks: Python folds and splits them as the tokenizer does.
_LATIN = re.compile("[!-~\xa1-\u012f\u0131-\u017f]+")
# Fixed value: the tokenizer's own rule for parts of a word.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# Marks after a word's last letter or number are one part, whatever they are.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# The byte-level alphabet: a printable character stands for its own byte, the others for the rest in order.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_ALPHABET = dict(zip([b for b in range(256) if b not in _PRINTABLE], range(256, 512)))
_encoders: dict = {}


class _Known(dict):
    """Remembers what a function returns; forgets all when there are too many keys."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Ids of a text as little-endian uint32 bytes.

    The tokenizer never joins anything across white space and drops it, so the ids of a text are those of its
    words one after another, and the ids of a word are those of its parts; frequent words and parts are remembered.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer, self.pattern = Tokenizer.from_file(path), regex.compile(_PARTS)
        self.model = self.tokenizer.model
        self.words, self.parts = _Known(self._word, CACHE_WORDS), _Known(self._part, CACHE_PARTS)

    def _plain(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        letters = part if part.isascii() else part.encode().decode("latin-1").translate(_ALPHABET)
        return b"".join([x.id.to_bytes(4, "little") for x in self.model.tokenize(letters)])

    def _word(self, word: str) -> bytes:
        if _LATIN.fullmatch(word) and "<|" not in word:  # special tokens begin so
            letters = word.rstrip(_MARKS)
            if letters.isalpha():  # two parts at most: no rule for what follows an apostrophe applies
                known = self.parts[letters.lower()]
                return known + self.parts[word[len(letters):]] if len(letters) < len(word) else known
            return b"".join(map(self.parts.__getitem__, self.pattern.findall(word.lower())))
        return self._plain(word)

    def ids(self, text: str) -> bytes:
        words = _PLAIN_SPACE.split(text) if _ODD_SPACE.search(text) else text.split()
        return b"".join(map(self.words.__getitem__, words))


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker and file."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget(path: str) -> None:
    """Drop the words that this Python worker's encoder remembers; the tokenizer itself stays."""
    encoder(path).words.clear()
    encoder(path).parts.clear()


def pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
           capacity: int = CAPACITY, end: int = 0, remember: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids and the end id; a null text is empty.

    Without ``remember`` words are remembered within a task only, and idle Python workers hold none of them.
    """
    kind = dict(docs.dtypes)[key]

    def make():
        code, last = encoder(tokenizer), np.array([end], "<u4").tobytes()

        def work(batch: pa.RecordBatch) -> dict:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, value in enumerate(batch.column("text").to_pylist()):
                ids = code.ids(value or "") + last
                for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    rows.append(row)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            return {"doc_id": batch.column("key").take(pa.array(rows, pa.int32())), "piece": piece, "start": start,
                    "length": length, "ids_crc32": crc}

        return work

    return map_rows(docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")),
                    f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint", make,
                    (lambda: None) if remember else (lambda: forget(tokenizer)))


class Bins:
    """Open sequences by free space: the fullest one that still takes a piece is found in one step."""

    def __init__(self, capacity: int):
        self.capacity, self.groups, self.free, self.mask = capacity, [], {}, 0

    def _file(self, group: list[int], free: int) -> None:
        self.free.setdefault(free, []).append(group)
        self.mask |= 1 << free

    def add(self, group: list[int], load: int) -> None:
        self.groups.append(group)
        self._file(group, self.capacity - load)

    def best_fit(self, item: int, size: int) -> None:
        fits = self.mask >> size
        if not fits:
            self.add([item], size)
            return
        free = size + (fits & -fits).bit_length() - 1
        group = self.free[free].pop()
        if not self.free[free]:
            self.mask ^= 1 << free
        group.append(item)
        self._file(group, free - size)


def grouping(sizes: list[int], items: list[int], kept: list[list[int]], capacity: int) -> list[list[int]]:
    """Best fit of the items, largest first, into the kept groups and new ones."""
    bins = Bins(capacity)
    for group in kept:
        bins.add(list(group), sum(sizes[i] for i in group))
    for i in items:
        bins.best_fit(i, sizes[i])
    return bins.groups


def fitness(sizes: list[int], groups: list[list[int]], capacity: int) -> float:
    """Mean squared fill: few, full groups."""
    return sum((sum(sizes[i] for i in g) / capacity) ** 2 for g in groups) / max(1, len(groups))


def crossover(sizes: list[int], one: list[list[int]], two: list[list[int]], capacity: int, rng: random.Random) -> list[list[int]]:
    """Well-filled groups of ``two`` put into ``one``; what they displace, and its worst groups, is best-fitted."""
    fill = [sum(sizes[i] for i in g) / capacity for g in two]
    good = [g for g, f in zip(two, fill, strict=True) if f >= WELL_FILLED and rng.random() < 0.5]
    placed = {i for g in good for i in g}
    kept, loose = list(good), []
    for group in one:
        if placed.isdisjoint(group) and (sum(sizes[i] for i in group) >= WELL_FILLED * capacity or rng.random() < 0.5):
            kept.append(group)
        else:
            loose += [i for i in group if i not in placed]
    loose.sort(key=lambda i: (-sizes[i], rng.random()))
    if len(loose) > 1 and rng.random() < 0.5:  # a few swaps, for another order than the greedy one
        for _ in range(1 + len(loose) // 16):
            a, b = rng.randrange(len(loose)), rng.randrange(len(loose))
            loose[a], loose[b] = loose[b], loose[a]
    return grouping(sizes, loose, kept, capacity)


def evolve(sizes: list[int], population: list[list[list[int]]], capacity: int, seed: int) -> list[list[list[int]]]:
    """The population after some generations, best first; it stops early at the least number of groups."""
    rng, least = random.Random(seed), math.ceil(sum(sizes) / capacity)
    if not population:
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
        population = [grouping(sizes, order, [], capacity)]
        while len(population) < POPULATION and len(population[0]) > least:
            other = order[:]
            for _ in range(1 + len(other) // 8):
                a, b = rng.randrange(len(other)), rng.randrange(len(other))
                other[a], other[b] = other[b], other[a]
            population.append(grouping(sizes, other, [], capacity))
    ranked = sorted(((fitness(sizes, p, capacity), n, p) for n, p in enumerate(population)), key=lambda x: (-x[0], x[1]))
    for _ in range(GENERATIONS * POPULATION if len(sizes) > 1 else 0):
        if len(ranked[0][2]) <= least:
            break
        one, two = ranked[0][2], ranked[rng.randrange(len(ranked))][2]
        child = crossover(sizes, *((one, two) if rng.random() < 0.5 else (two, one)), capacity, rng)
        ranked.append((fitness(sizes, child, capacity), len(ranked), child))
        ranked.sort(key=lambda x: (-x[0], x[1]))
        del ranked[POPULATION:]
    return [p for _, _, p in ranked]


def _code(groups: list[list[int]], n: int) -> bytes:
    out = np.zeros(n, np.int32)
    for number, group in enumerate(groups):
        out[group] = number
    return out.tobytes()


def _decode(code: bytes) -> list[list[int]]:
    of = np.frombuffer(code, np.int32)
    order = np.argsort(of, kind="stable")
    return [x.tolist() for x in np.split(order, np.flatnonzero(np.diff(of[order])) + 1)] if len(of) else []


_GENOMES = "shard bigint, island int, migrant boolean, keys binary, sizes binary, population array<binary>, fitness double"


def _row(shard: int, island: int, keys: np.ndarray, sizes: list[int], population: list, capacity: int) -> pd.DataFrame:
    return pd.DataFrame({
        "shard": [shard], "island": [island], "migrant": [False], "keys": [keys.astype(np.int64).tobytes()],
        "sizes": [np.array(sizes, np.int64).tobytes()], "population": [[_code(p, len(sizes)) for p in population]],
        "fitness": [fitness(sizes, population[0], capacity)]})


def _evolved(open_items: DataFrame, shards: int, capacity: int, seed: int) -> DataFrame:
    """The best grouping of each shard: shard, keys, sizes, best (codes)."""
    islands = open_items.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(shards))) \
        .withColumn("island", F.explode(F.array([F.lit(i) for i in range(ISLANDS)])))

    def begin(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("key")
        shard, island, sizes = int(rows["shard"].iat[0]), int(rows["island"].iat[0]), rows["length"].tolist()
        found = evolve(sizes, [], capacity, hash((seed, shard, island, 0)))
        return _row(shard, island, rows["key"].to_numpy(), sizes, found, capacity)

    def go_on(epoch: int):
        def step(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("migrant")
            own = rows.iloc[0]
            sizes, keys = np.frombuffer(own["sizes"], np.int64).tolist(), np.frombuffer(own["keys"], np.int64)
            population = [_decode(code) for codes in rows["population"] for code in codes]
            found = evolve(sizes, population, capacity, hash((seed, int(own["shard"]), int(own["island"]), epoch)))
            return _row(int(own["shard"]), int(own["island"]), keys, sizes, found, capacity)

        return step

    state = islands.groupBy("shard", "island").applyInPandas(begin, _GENOMES)
    for epoch in range(1, EPOCHS):
        state = state.select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("moves")).select(
            "shard", F.when(F.col("moves"), F.expr(f"(island + 1) % {ISLANDS}")).otherwise(F.col("island")).alias("island"),
            F.col("moves").alias("migrant"), "keys", "sizes",
            F.when(F.col("moves"), F.slice("population", 1, 1)).otherwise(F.col("population")).alias("population"),
            "fitness").groupBy("shard", "island").applyInPandas(go_on(epoch), _GENOMES)
    return state.groupBy("shard").agg(F.max_by(F.struct("keys", "sizes", F.expr("population[0]").alias("best")),
                                               F.struct("fitness", F.expr("-island").alias("first"))).alias("x")) \
        .select("shard", "x.*")


def _placed(best: DataFrame, level: int, capacity: int, last: bool) -> DataFrame:
    """key, length, final, sequence_id, offset of every piece of the groupings."""
    enough = 0 if last else (1 - (1 - WELL_FILLED) * 4 ** level) * capacity

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("key", "length", "final", "sequence_id", "offset")}
            for shard, keys, sizes, code in zip(*(batch.column(c).to_pylist() for c in ("shard", "keys", "sizes", "best")), strict=True):
                keys, sizes = np.frombuffer(keys, np.int64).tolist(), np.frombuffer(sizes, np.int64).tolist()
                for number, group in enumerate(_decode(code)):
                    at = 0
                    final = sum(sizes[i] for i in group) >= enough
                    for i in group:
                        out["key"].append(keys[i])
                        out["length"].append(sizes[i])
                        out["final"].append(final)
                        out["sequence_id"].append((level << 56) | (shard << 16) | number)
                        out["offset"].append(at)
                        at += sizes[i]
            return out

        return work

    return map_rows(best, "key bigint, length bigint, final boolean, sequence_id bigint, offset bigint", make)


def pack(cut_pieces: DataFrame, *, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """The pieces with sequence_id and offset: no sequence is longer than ``capacity``, none has a gap.

    Takes the columns of ``pieces``; repeated rows are pieces of their own. Full pieces are sequences as they
    are. An empty table gives no rows.
    """
    stored = cut(cut_pieces.withColumn("key", F.monotonically_increasing_id()))
    whole = stored.where(F.col("length") >= capacity).select("key", (-1 - F.col("key")).alias("sequence_id"),
                                                           F.lit(0).cast("bigint").alias("offset"))
    left, done, level = stored.where(F.col("length") < capacity).select("key", "length"), [whole], 0
    count = left.count()
    while count:
        shards = math.ceil(count / shard)
        placed = cut(_placed(_evolved(left, shards, capacity, level), level, capacity, shards == 1))
        done.append(placed.where("final").select("key", "sequence_id", "offset"))
        left, level = placed.where("not final").select("key", "length"), level + 1
        count = left.count()
    places = done[0]
    for more in done[1:]:
        places = places.unionByName(more)
    return stored.join(places, "key").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
