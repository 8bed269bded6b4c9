"""Exact substring duplicates: breadth-first interval expansion on Burrows-Wheeler transforms.

Every string of ``length`` bytes names an anchor, the place of the smallest hash of its short grams, by its own
bytes alone; so equal strings have equal anchors. Neighbouring strings with one anchor form a segment of text.

* Segments are counted by anchor and content. Equal segments are repeated as a whole; anchors seen in one
  content only are settled. What is left are different contents around one anchor, which may share strings.
* Contents of an anchor come to one task, many anchors to a task. There a suffix array of a bounded batch
  gives its BWT, and intervals are extended backward, breadth first: level by level they bring the common
  prefixes in increasing length. The expansion stops at ``length``; suffixes not yet told apart by then share it.
* An anchor with more content than a batch is refined first: its strings are split by their distance from
  the anchor, and keyed by all the bytes that the strings of such a part have in common. Parts equal as a
  whole are settled by counting; the last refinement is one string to a key.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapstats.llm.common import beside, cut, kind_of, map_rows, runs

LENGTH = 400
#: Bytes of a gram: common lines shorter than it do not bring contents together that share no string.
GRAM = 128
#: Bytes in a batch, and of an anchor's contents before it is refined.
BATCH_BYTES = 1 << 17
#: Places in a batch of strings that are compared one by one.
PLACES = 1 << 16
#: Text scanned at once; neighbouring pieces overlap by a string less one byte.
PIECE = 1 << 22

_BASE = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all grams of ``size`` bytes, a power of two, by doubling."""
    out, width = data.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB), 1
    while width < size:
        factor = np.uint64(pow(_BASE, width, 1 << 64))
        out = out[:-width] * factor + out[width:]
        width *= 2
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values: a prefix and a suffix minimum of blocks meet in it."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    padded = padded.reshape(blocks, width)
    left = np.minimum.accumulate(padded, axis=1).ravel()
    right = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - width + 1], left[width - 1:n])


def segments(data: bytes, length: int) -> list[tuple[int, int, int, int]]:
    """(start, strings, place of the anchor in the segment, anchor): the strings of a text by anchor, in order."""
    out = []
    for base in range(0, max(0, len(data) - length + 1), PIECE):
        part = np.frombuffer(data, np.uint8, min(len(data) - base, PIECE + length - 1), base)
        hashes = gram_hashes(part, min(GRAM, 1 << (length.bit_length() - 2)))
        # Ties go to the rightmost place, so that the bytes of a string decide.
        keys = (hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
        anchor = (_LOW - (sliding_min(keys, length - (len(part) - len(hashes))) & _LOW)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        many = np.diff(np.append(first, len(anchor)))
        place = anchor[first]
        out += zip((first + base).tolist(), many.tolist(), (place - first).tolist(),
                   hashes[place].astype(np.int64).tolist(), strict=True)
    return out


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of each) by prefix doubling; only suffixes not yet told apart are sorted again."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    ranks = np.empty(2 * n, np.int64)
    ranks[n:] = -1
    active, group = order, codes[order]
    same = np.concatenate(([False], group[1:] == group[:-1]))
    rank = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    width = 1
    while True:
        ranks[active] = rank
        alone = ~same & ~np.append(same[1:], False)
        active, rank = active[~alone], rank[~alone]
        if not len(active):
            break
        second = ranks[np.minimum(active + width, 2 * n - 1)]
        by = np.argsort(rank * (n + 1) + second + 1, kind="stable")
        active, rank, second = active[by], rank[by], second[by]
        start = np.concatenate(([True], rank[1:] != rank[:-1]))
        same = np.concatenate(([False], (rank[1:] == rank[:-1]) & (second[1:] == second[:-1])))
        at = np.arange(len(active))
        inside = np.maximum.accumulate(np.where(same, 0, at)) - np.maximum.accumulate(np.where(start, at, 0))
        rank = rank + inside
        width *= 2
    ranks = ranks[:n]
    order = np.empty(n, np.int64)
    order[ranks] = np.arange(n)
    return order, ranks


def repeated_strings(contents: list[bytes], length: int) -> list[np.ndarray]:
    """For each content, whether the string of ``length`` bytes at each place occurs anywhere else among them.

    Contents end in codes of their own, so no string crosses an end. Of the common prefixes of neighbouring
    suffixes, those shorter than ``length`` are found in increasing order; the rest is long enough.
    """
    sizes = [len(c) for c in contents]
    ends = np.cumsum(sizes) + np.arange(len(sizes))
    codes = np.empty(sum(sizes) + len(sizes), np.int64)
    codes[ends] = np.arange(len(sizes))
    inside = np.ones(len(codes), bool)
    inside[ends] = False
    codes[inside] = np.frombuffer(b"".join(contents), np.uint8).astype(np.int64) + len(sizes)
    n = len(codes)
    order, rank = suffix_array(codes)
    step = rank[order - 1]  # from a suffix to the one that starts a character earlier: the transform's LF mapping
    back = np.empty(n, np.int64)
    back[step] = np.arange(n)
    letter = codes[order - 1]  # the transform itself
    by_letter = letter[back]
    new = np.concatenate(([True], by_letter[1:] != by_letter[:-1]))
    before, after = np.empty(n, np.int64), np.empty(n, np.int64)  # the same letter's neighbours in the transform
    before[back] = np.where(new, -1, np.concatenate(([-1], back[:-1])))
    after[back] = np.where(np.append(new[1:], True), n, np.append(back[1:], n))

    known = np.zeros(n + 1, bool)  # places whose common prefix with the one before is shorter than the level
    known[[0, n]] = True
    low, high = np.array([0]), np.array([n - 1])
    for _ in range(length):  # intervals of strings of the level's length
        wide = high > low
        single, low, high = low[~wide], low[wide], high[wide]
        count = high - low + 1
        at = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        first = at[before[at] < np.repeat(low, count)]
        last = at[after[at] > np.repeat(high, count)]
        one = step[single]
        low, high = np.concatenate((np.sort(step[first]), one)), np.concatenate((np.sort(step[last]), one))
        fresh = ~known[high + 1]
        low, high = low[fresh], high[fresh]
        known[high + 1] = True
        if not len(low):
            break
    shared = ~known  # with the suffix before it
    found = np.zeros(n, bool)
    found[order] = shared[:n] | shared[1:]
    return [found[e - s:e] for e, s in zip(ends.tolist(), sizes, strict=True)]


_CONTENTS = "key bigint, low int, high int, content binary, n bigint, place int, strings int, shift int, bytes binary"
_RANGES = "content binary, low int, high int"


def _batches(length: int):
    """Batches of whole keys: their contents that occur once, and the places where they repeat others."""

    def settle(batch: list[tuple]) -> pa.RecordBatch:
        out: tuple[list, list, list] = ([], [], [])
        for (_, content, n, shift, data), found in zip(batch, repeated_strings([x[4] for x in batch], length), strict=True):
            for a, b in runs(found[:len(data) - length + 1]) if n == 1 else ():
                out[0].append(content)
                out[1].append(shift + a)
                out[2].append(shift + b)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int32())],
                                          names=["content", "low", "high"])

    def run(batches):
        batch: list[tuple] = []
        size = 0
        for rows in batches:
            for row in zip(*(rows.column(c).to_pylist() for c in ("key", "content", "n", "shift", "bytes")), strict=True):
                if size >= BATCH_BYTES and row[0] != batch[-1][0]:
                    yield settle(batch)
                    batch, size = [], 0
                batch.append(row)
                size += len(row[4])
        if batch:
            yield settle(batch)

    return run


def _quarters(length: int):
    """Each content cut to the strings of each quarter of its distances from the anchor."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("key", "low", "high", "content", "n", "place", "strings", "shift", "bytes", "parent")}
        names = ("key", "low", "high", "content", "n", "place", "strings", "shift", "bytes")
        for key, low, high, content, n, place, strings, shift, data in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            step = max(1, (high - low) // 4)
            for lo in range(low, high, step):
                hi = lo + step
                a, b = max(0, place - hi + 1), min(strings, place - lo + 1)
                if a < b:
                    part, core = data[a:b - 1 + length], data[place - lo:place - hi + 1 + length]
                    here = xxhash.xxh3_64(b"%d %d %d " % (key, lo, hi))
                    here.update(core)
                    for k, v in (("key", here.intdigest() - (1 << 63)), ("low", lo), ("high", hi), ("content", xxhash.xxh3_128_digest(part)),
                                 ("n", n), ("place", place - a), ("strings", b - a), ("shift", shift + a), ("bytes", part), ("parent", content)):
                        out[k].append(v)
        return out

    return work


def _strings(length: int):
    """The wanted places of each piece one by one, with digests of their strings, in batches of about ``PLACES``: there may be as many as bytes."""

    def work(batch: pa.RecordBatch) -> Iterator[dict]:
        rows, starts, digests, size = [], [], [], 0  # a place has no Python objects of its own: there may be millions

        def out() -> dict:
            at = pa.array(np.concatenate(rows or [np.empty(0, np.int32)]))
            edges = np.arange(len(at) + 1, dtype=np.int32) * 16
            return {c: batch.column(c).take(at) for c in ("row", "piece")} | {
                "start": pa.array(np.concatenate(starts or [np.empty(0, np.int64)])),
                "string": pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(edges), pa.py_buffer(b"".join(digests))])}

        for n, (data, wanted) in enumerate(zip(batch.column("data"), batch.column("wanted"), strict=True)):
            data = data.as_py()
            for x in wanted.as_py():
                rows.append(np.full(x["strings"], n, np.int32))
                starts.append(np.arange(x["start"], x["start"] + x["strings"], dtype=np.int64))
                digests.append(b"".join(xxhash.xxh3_128_digest(data[at:at + length]) for at in range(x["start"], x["start"] + x["strings"])))
                size += x["strings"]
                if size >= PLACES:
                    yield out()
                    rows, starts, digests, size = [], [], [], 0
        yield out()

    return work


def find(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``row`` (id and text hash) and ``spans`` (start and end in UTF-8 bytes, in order, apart) of what repeats.

    A byte is in a span when a string of ``length`` bytes that covers it also starts anywhere else, in the same
    text or another row's; overlapping strings count. Rows without such bytes are missing. Strings never cross rows;
    null texts have none. Rows alike in id and text are one row here, and repeat each other.
    """
    return _settled(*_repeated(docs, key, text, length), length)


def _repeated(docs: DataFrame, key: str, text: str, length: int) -> tuple[DataFrame, DataFrame]:
    """The segments of anchors that occur more than once, and the text under them as ``row``, ``piece`` (where it starts), ``data``.

    Texts meet these segments once, and only then are contents digested; whatever follows reads the pieces.
    """
    def cut_up():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("start", "strings", "place", "anchor")}
            rows = []
            for n, data in enumerate(batch.column("data").to_pylist()):
                for start, strings, place, anchor in segments(data, length) if data else ():
                    rows.append(n)
                    out["start"].append(start)
                    out["strings"].append(strings)
                    out["place"].append(place)
                    out["anchor"].append(anchor)
            return out | {"row": batch.column("row").take(pa.array(rows, pa.int32()))}

        return work

    def pieces():
        def work(batch: pa.RecordBatch) -> dict:
            rows: list[int] = []
            out: dict[str, list] = {k: [] for k in ("piece", "data", "parts")}
            for n, (data, found) in enumerate(zip(batch.column("data").to_pylist(), batch.column("parts").to_pylist(), strict=True)):
                found = [x | {"end": x["start"] + x["strings"], "content": xxhash.xxh3_128_digest(data[x["start"]:x["start"] + x["strings"] + length - 1])}
                         for x in found]
                done = 0
                for a, b in spans(found, 1):
                    upto = bisect_left(found, b, done, key=lambda x: x["start"])
                    rows.append(n)
                    out["piece"].append(a)
                    out["data"].append(data[a:b - 1 + length])
                    out["parts"].append(found[done:upto])
                    done = upto
            return out | {"row": batch.column("row").take(pa.array(rows, pa.int32()))}

        return work

    row = f"row struct<id:{dict(docs.dtypes)[key]},hash:bigint>"
    rows = with_row(docs, key, text)
    part = "start:bigint,strings:int,place:int,anchor:bigint"
    parts = map_rows(rows, f"{row}, {part.replace(':', ' ')}", cut_up)
    # An anchor is one row a task, however many texts have it; stored, so that Spark can split a hot one in the join.
    again = cut(parts.groupBy("anchor").count().where("count > 1").select("anchor"))
    parts = parts.join(again, "anchor").groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "strings", "place", "anchor"))).alias("parts"))
    pieces = cut(map_rows(rows.join(parts, "row").select("row", "data", "parts"),
                          f"{row}, piece bigint, data binary, parts array<struct<{part},content:binary>>", pieces))
    return pieces.selectExpr("row", "inline(parts)"), pieces.drop("parts")


def _all(rounds: list[DataFrame]) -> DataFrame:
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def _settled(parts: DataFrame, pieces: DataFrame, length: int) -> DataFrame:
    counted = parts.groupBy("anchor", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "start", "strings", "place")).alias("at"))
    again = counted.groupBy("anchor").agg(F.count("*").alias("contents"), F.min("n").alias("least"),
                                          F.sum(F.col("at.strings") + (length - 1)).alias("bytes"))
    counted = cut(counted.join(again, "anchor"))
    whole = counted.where("n > 1").select("content", F.lit(0).alias("low"), F.col("at.strings").alias("high"))
    wanted = counted.where("contents > 1 and least = 1").select(
        "at.row", F.struct("anchor", "content", "n", "at.start", "at.strings", "at.place", "bytes").alias("x")) \
        .groupBy("row").agg(F.collect_list("x").alias("wanted"))

    def fetch():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("key", "low", "high", "content", "n", "place", "strings", "shift", "bytes", "total")}
            for at, data, wanted in zip(*(batch.column(c).to_pylist() for c in ("piece", "data", "wanted")), strict=True):
                for x in wanted:
                    if not at <= x["start"] < at + len(data) - length + 1:
                        continue  # of another piece
                    part = data[x["start"] - at:x["start"] - at + x["strings"] + length - 1]
                    for k, v in (("key", x["anchor"]), ("low", 0), ("high", 1 << (length - 1).bit_length()), ("content", x["content"]), ("n", x["n"]),
                                 ("place", x["place"]), ("strings", x["strings"]), ("shift", 0), ("bytes", part), ("total", x["bytes"])):
                        out[k].append(v)
            return out

        return work

    found = cut(map_rows(pieces.join(wanted, "row").select("piece", "data", "wanted"), _CONTENTS + ", total bigint", fetch))
    small, quarters = [], []
    limit = 2 * BATCH_BYTES
    while True:
        small.append(found.where(F.col("total") <= limit).select("key", "content", "n", "shift", "bytes"))
        large = found.where(F.col("total") > limit)
        if large.isEmpty():
            break
        parted = cut(map_rows(large.drop("total"), _CONTENTS + ", parent binary", lambda: _quarters(length)))
        quarters.append(parted.select("key", "content", "n", "parent", "shift", "strings"))
        # What is equal as a whole is settled below; one of each content stays for others to be compared with.
        one = parted.groupBy("key", "content").agg(
            F.sum("n").alias("n"), F.min(F.struct("low", "high", "place", "strings", "shift", "parent", "bytes")).alias("x"))
        more = one.groupBy("key").agg(F.count("*").alias("contents"), F.min("n").alias("least"), F.sum(F.length("x.bytes")).alias("total")) \
            .where("contents > 1 and least = 1").select("key", "total")
        found = cut(one.join(more, "key").select("key", "x.low", "x.high", F.col("x.parent").alias("content"), "n", "x.place", "x.strings",
                                                 "x.shift", "x.bytes", "total"))
    # Keys of different rounds differ, so what the rounds have left is dealt and settled in one go.
    settled = whole.unionByName(_all(small).repartition("key").sortWithinPartitions("key").mapInArrow(_batches(length), _RANGES))
    if quarters:
        parted = _all(quarters)
        alike = parted.groupBy("key", "content").agg(F.sum("n").alias("n")).where("n > 1").select("key", "content")
        settled = settled.unionByName(parted.where("n = 1").join(alike, ["key", "content"]).select(
            F.col("parent").alias("content"), F.col("shift").alias("low"), (F.col("shift") + F.col("strings")).alias("high")))
    return parts.select("row", "start", "content").join(cut(settled.select("content", "low", "high")), "content") \
        .select("row", F.struct((F.col("start") + F.col("low")).alias("start"), (F.col("start") + F.col("high")).alias("end")).alias("x")) \
        .groupBy("row").agg(F.sort_array(F.collect_list("x")).alias("starts"))


def _later(pieces: DataFrame, starts: DataFrame, length: int) -> DataFrame:
    """``row`` and ``later``: those of the places that ``find`` gives (``starts``) whose string also starts before, as ranges that are apart.

    Before is in a smaller row (id, then hash of the text; no id is the smallest) or at a smaller place. Only repeated text is cut
    to segments again. Equal segments are settled by their first one; strings are compared one by one only
    between different segments of one anchor, where their edges differ.
    """
    def narrow():
        def work(batch: pa.RecordBatch) -> dict:
            found = [(n, a, data[a - at:b - at - 1 + length])
                     for n, (at, data, ranges) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("piece", "data", "starts")), strict=True))
                     for a, b in spans(ranges, 1) if at <= a < at + len(data) - length + 1]
            return {"row": batch.column("row").take(pa.array([x[0] for x in found], pa.int32())),
                    "piece": [x[1] for x in found], "data": [x[2] for x in found]}

        return work

    def cut_up():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("start", "strings", "anchor", "content")}
            rows = []
            for n, data in enumerate(batch.column("data").to_pylist()):
                for start, strings, _, anchor in segments(data, length):
                    rows.append(n)
                    out["start"].append(start)
                    out["strings"].append(strings)
                    out["anchor"].append(anchor)
                    out["content"].append(xxhash.xxh3_128_digest(data[start:start + strings + length - 1]))
            return out | {c: batch.column(c).take(pa.array(rows, pa.int32())) for c in ("row", "piece")}

        return work

    row = f"row {kind_of(pieces, F.col('row'))}, piece bigint"
    repeated = cut(map_rows(pieces.join(starts, "row").select("row", "piece", "data", "starts"), f"{row}, data binary", narrow))
    parts = map_rows(repeated, f"{row}, start bigint, strings int, anchor bigint, content binary", cut_up)
    place = F.struct("row", (F.col("piece") + F.col("start")).alias("at"))
    # One row of a segment for each task, however many texts have it; stored, so that Spark can split a hot one in the join.
    firsts = cut(parts.groupBy("anchor", "content").agg(F.min(F.struct(place.alias("place"), "piece", "start", "strings")).alias("x"))
                 .select("anchor", "content", "x.*"))
    again = parts.join(firsts.select("content", F.col("place").alias("first")), "content").where(place != F.col("first")) \
        .select("row", place["at"].alias("start"), "strings")
    many = firsts.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1").select("anchor")
    wanted = firsts.join(many, "anchor").groupBy("place.row", "piece").agg(F.collect_list(F.struct("start", "strings")).alias("wanted"))
    strings = cut(map_rows(repeated.join(wanted, ["row", "piece"]).select("row", "piece", "data", "wanted"),
                           f"{row}, start bigint, string binary", lambda: _strings(length)))
    least = strings.groupBy("string").agg(F.min(place).alias("first"))
    behind = strings.join(least, "string").where(place != F.col("first")).select("row", place["at"].alias("start"), F.lit(1).alias("strings"))
    # Neighbouring places become one range before those of a row are gathered: a long copy has as many places as bytes.
    order, end = Window.partitionBy("row").orderBy("start"), F.col("start") + F.col("strings")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ranges = again.unionByName(behind).withColumn("apart", F.when(F.col("start") <= before, 0).otherwise(1)) \
        .withColumn("range", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))) \
        .groupBy("row", "range").agg(F.min("start").alias("start"), F.max(end).alias("end"))
    return ranges.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("later"))


def with_row(docs: DataFrame, key: str, text: str, *more: F.Column) -> DataFrame:
    data = F.col(text).cast("string").cast("binary")
    return docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(data).alias("hash")).alias("row"), data.alias("data"),
                       *(c.alias("rest") for c in more))


def spans(starts: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Byte spans covered by strings that start in the given (sorted) ranges."""
    out: list[list[int]] = []
    for x in starts or ():
        a, b = x["start"], x["end"] - 1 + length
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def copied(data: bytes, starts: list[dict] | None, later: list[dict] | None, length: int, own: int) -> list[tuple[int, int]]:
    """Byte spans of strings that start in the ranges of ``later``, less those of the other (first) strings in ``starts``.

    First strings in a row that bring fewer than ``own`` bytes outside these spans hold back nothing, unless one overlaps its own repeat.
    """
    if not later:
        return []
    size = max(x["end"] for x in starts) - 1 + length
    first, gone = np.zeros(size, bool), np.zeros(size, bool)
    for a, b in spans(later, length):
        gone[a:b] = True
    for x in starts:
        first[x["start"]:x["end"]] = True
    for x in later:
        first[x["start"]:x["end"]] = False
    kept = np.zeros(size, bool)
    for a, b in runs(first):
        end = b - 1 + length
        if end - a - np.count_nonzero(gone[a:end]) >= own or any(data.find(data[i:i + length], i + 1, i - 1 + 2 * length) >= 0 for i in range(a, b)):
            kept[a:end] = True
    return runs(gone & ~kept)


def kept_bytes(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in gone for x in s), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def remove(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans, and kept_text.

    Spans are judged on the input, as ``find`` says. kept_sha256 is of the remaining bytes; kept_text also leaves
    out the bytes of a character of which only a part remains. A null text is empty, and its kept_text null.
    Options: key, text and length.
    """
    return _removed(docs, **options).drop("rest")


def clean(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep_first: bool = False, own: int = 0) -> DataFrame:
    """``docs`` with what is left of the texts; n_chars, if there is such a column, is counted anew.

    With ``keep_first`` every repeated string stays at its first place (``_later`` has the order): a byte goes if a string
    that covers it starts anywhere before and none that covers it is the first of its kind.

    A passage that is copied between like words, such as the blanks around it, has first strings across its edges, and these
    would hold a copy back. With ``own`` they do not, if they bring fewer than ``own`` bytes besides what is copied: every byte that
    goes still starts before as part of a repeated string, and what is new beside it stays.
    """
    left = _removed(docs, key=key, text=text, length=length, keep_first=keep_first, own=own)
    new = {key: F.col("doc_id"), text: F.col("kept_text"), "n_chars": F.length("kept_text").cast("bigint")}
    return left.select(*((new[c] if c in new else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))


def _removed(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, keep_first: bool = False, own: int = 0) -> DataFrame:
    kind, rest = dict(docs.dtypes)[key], beside(docs, key, text)
    parts, pieces = _repeated(docs, key, text, length)
    starts = cut(_settled(parts, pieces, length))
    if keep_first:
        starts = starts.join(_later(pieces, starts, length), "row", "left")
    else:
        starts = starts.withColumn("later", F.lit(None).cast("array<struct<start:bigint,end:bigint>>"))
    joined = with_row(docs, key, text, rest).join(starts, "row", "left")

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept_text")}
            for data, starts, behind in zip(*(batch.column(c).to_pylist() for c in ("data", "starts", "later")), strict=True):
                gone = copied(data, starts, behind, length, own) if keep_first else spans(starts, length)
                left = kept_bytes(data or b"", gone)
                out["n_bytes"].append(len(data or b""))
                out["n_removed"].append(sum(b - a for a, b in gone))
                out["n_spans"].append(len(gone))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["spans"].append([{"start": a, "end": b} for a, b in gone])
                out["kept_text"].append(None if data is None else left.decode(errors="ignore"))
            return out | {"doc_id": batch.column("doc_id"), "rest": batch.column("rest")}

        return work

    return map_rows(joined.select(F.col("row.id").alias("doc_id"), "data", "starts", "later", "rest"),
                    f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                    f"spans array<struct<start:bigint,end:bigint>>, kept_text string, rest {kind_of(docs, rest)}", make)
