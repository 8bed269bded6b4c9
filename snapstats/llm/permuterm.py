"""Spelling variants by permuterm rotations.

A word is marked with a terminator and rotated to every place: the rotation behind a character, but for its last one,
is the word without that character, written so that the gap is at the end. Words that differ by a replaced character
share such a prefix; a word that lacks the character has it as a whole rotation. So all rotations are sorted by prefix and
the groups of a prefix are scanned in order: its members are neighbours of each other, and of the word that it spells.

Words are distinct, and members of a group differ in one character only: a group has no more rows than there are letters.
A scan keeps a count and the two best words of a group, never its pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import cut, map_rows

#: Letters of words, the sampled deletion (one run of ``ONE_IN``), and the least word to be compared.
RUN = re.compile("[a-zÀ-ÿ]+")
ONE_IN = 199
LEAST_LENGTH, LEAST_COUNT = 6, 5
#: A word's form is this many times as frequent, at least.
TIMES = 5
END = "$"
#: Words a task counts before it hands them on.
HELD_WORDS = 200_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(key, text: str | None, one_in: int | None = ONE_IN) -> Counter:
    """Words of a text and their occurrences; runs of which ``one_in`` divides the hash have lost a character."""
    runs = Counter(RUN.findall(text.encode().translate(_LOWER).decode())) if text else Counter()
    if one_in is None:
        return runs
    out: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
        if h % one_in == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        out[run] += n
    return out


def count(docs: DataFrame, *, key: str = "doc_id", text: str = "text", one_in: int | None = ONE_IN, least_length: int = LEAST_LENGTH,
          least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): the words of ``least_length`` characters that occur ``least_count`` times in all texts together.

    Every task adds up its own words and hands on sums. A null or empty text has no words; a null key counts as an empty one;
    rows that repeat count each time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc, body in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for word, n in words_of(doc, body, one_in).items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, whole, last, word, n): every rotation of every marked word, once as a prefix with its last character cut off
    and once whole.

    ``last`` tells whether the cut character differs from the one behind it: of a row of equal characters any may be
    the one that another word lacks, and only the last is taken, so that two words meet in one prefix.
    """
    marked = F.concat("word", F.lit(END))
    places = F.explode(F.sequence(F.lit(0), F.length("word"))).alias("at")
    turned = words.select("word", "n", marked.alias("marked"), places).select(
        "word", "n", "at", F.concat(F.expr("substr(marked, at + 1)"), F.expr("substr(marked, 1, at)")).alias("rotation"))
    # The rotation to place 0 ends in the terminator, which no edit touches.
    skipped = F.when(F.col("at") > 0, F.struct(
        F.expr("substr(rotation, 1, length(rotation) - 1)").alias("prefix"), F.lit(False).alias("whole"),
        F.expr("right(rotation, 1) <> left(rotation, 1)").alias("last")))
    whole = F.struct(F.col("rotation").alias("prefix"), F.lit(True).alias("whole"), F.lit(True).alias("last"))
    return turned.select("word", "n", F.explode(F.array(skipped, whole)).alias("x")).where("x is not null").select("x.*", "word", "n")


def scan(group: list[tuple[str, int, bool, bool]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, neighbours, n of the best, the best) for each word of a prefix that has any in its group.

    ``group`` has (word, n, whole, last). The best is the most frequent, then the first in code-point order.
    """
    members = [(-n, word, last) for word, n, whole, last in group if not whole]
    spelled = next(((-n, word) for word, n, whole, _ in group if whole), None)
    ends = [x[:2] for x in members if x[2]]
    top = sorted(x[:2] for x in members)[:2]
    for n, word, last in members:
        near = len(members) - 1 + (spelled is not None and last)
        if near:
            best = min([x for x in top if x[1] != word] + [spelled] * (spelled is not None and last))
            yield word, near, -best[0], best[1]
    if spelled and ends:
        best = min(ends)
        yield spelled[1], len(ends), -best[0], best[1]


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many of the distinct ``words`` (word, n) differ by one edit, and (n, word) of the most frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefix, group = None, []
        for batch in batches:
            out = []
            for now, *row in zip(*(batch.column(c).to_pylist() for c in ("prefix", "word", "n", "whole", "last")), strict=True):
                if now != prefix:
                    out += scan(group) if len(group) > 1 else ()
                    prefix, group = now, []
                group.append(row)
            yield _near(out)
        if len(group) > 1:
            yield _near(list(scan(group)))

    found = rotations(words).repartition("prefix").sortWithinPartitions("prefix").mapInArrow(run, "word string, near bigint, n bigint, best string")
    # The most frequent and, of those, the first in code-point order (that of the bytes).
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("minus"), F.col("best").alias("word"))).alias("x")) \
        .select("word", "n_near", F.struct((-F.col("x.minus")).alias("n"), F.col("x.word").alias("word")).alias("best"))


def _near(rows: list[tuple[str, int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                      names=["word", "near", "n", "best"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead from each word that has one, by doubling the steps until none changes.

    ``forms`` is (word, form). A form is several times as frequent as its word, so there is no ring, and the rounds are as few
    as the logarithm of the longest chain; every round is stored in the shared folder.
    """
    links = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = step.drop("moved")
        if step.where("moved").isEmpty():
            return links


def variants(docs: DataFrame, *, times: int = TIMES, **options) -> DataFrame:
    """One row per counted word of ``docs``: word, n, n_near, form, form_n, root.

    ``form`` is the most frequent word one edit away (ties: the first in code-point order) if it occurs ``times`` times as often, else
    null; ``root`` is where forms lead to, the word itself without one. Options and rules for nulls, empty and repeated
    texts: those of ``count``. Other columns are not read.
    """
    words = cut(count(docs, **options))
    near = cut(words.join(neighbours(words), "word", "left"))
    fits = F.col("best.n") >= times * F.col("n")
    out = near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                      F.when(fits, F.col("best.word")).alias("form"), F.when(fits, F.col("best.n")).alias("form_n"))
    ends = roots(out.where("form is not null").select("word", "form"))
    return out.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
