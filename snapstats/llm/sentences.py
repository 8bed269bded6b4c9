"""Substring duplicates by sliding sentence spans.

A span is a run of consecutive sentences with ``WORDS`` words or more together, one long sentence or several short ones. From every
sentence the shortest span forward and the shortest one backward are hashed; together they cover every longer span. A span that occurs
anywhere before (in a smaller doc_id, or earlier in the text) is a copy, and the sentences it covers are removed.
The first occurrence of a span makes no sentence go.
"""

from __future__ import annotations

import re
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import cut, map_rows

#: Shorter spans are stock sentences of a source (headings, notices, closing lines) rather than copied passages.
WORDS = 20
# Marks that end sentences, and scripts without blanks between words (Thai to Khmer, kana, Han), as code points in hex;
# every letter of these scripts counts as a word.
ENDS = "21 2E 3F A 589 61F 6D4 964 965 1362 203C 2047-2049 3002 FE52 FF01 FF0E FF1F FF61"
CLOSERS = "22 27 29 5D BB 2019 201D 300D 300F"
UNSPACED = "E00-EFF 1000-109F 1780-17FF 3005-3007 3040-30FF 3400-4DBF 4E00-9FFF F900-FAFF 20000-3FFFF"


def _class(points: str, form: str) -> str:
    """Content of a character class; ``form`` prints one code point."""
    return "".join("-".join(form.format(int(x, 16)) for x in part.split("-")) for part in points.split())


def patterns(form: str) -> tuple[str, str, str]:
    """(a sentence with its marks and the blanks behind, a word, a letter that is a word) for a pattern language that prints code points so."""
    ends, closers, unspaced = (_class(x, form) for x in (ENDS, CLOSERS, UNSPACED))
    blanks = _class("9-D 20", form)
    return (rf"[^{ends}]*[{ends}]+[{closers}]*[{blanks}{_class('3000', form)}]*|[^{ends}]+",
            f"[{unspaced}]|[^{blanks}{unspaced}]+", f"[{unspaced}]")


_SENTENCE, _WORD, _ALONE = map(re.compile, patterns("\\U{:08X}"))


def split(text: str | None) -> list[str]:
    """Sentences of a text with their marks and the blanks behind; joined they are the text."""
    return _SENTENCE.findall(text or "")


def flat(sentence: str) -> tuple[str, int]:
    """(the sentence in lower case with single blanks, its words)."""
    words = sentence.lower().encode().split()
    out = b" ".join(words).decode()
    return out, len(_WORD.findall(out)) if _ALONE.search(out) else len(words)


def spans(parts: list[tuple[str, int]], words: int) -> list[tuple[int, int]]:
    """(first sentence from 1, how many) of the shortest spans forward from and backward to each sentence; ``parts`` as of ``flat``."""
    total = list(accumulate((n for _, n in parts), initial=0))
    out, low = set(), 0
    for end in range(1, len(parts) + 1):
        # ``low`` is the first sentence from which no span up to an earlier end was long enough.
        while total[end] - total[low] >= words:
            out.add((low + 1, end - low))
            low += 1
        if low:
            out.add((low, end - low + 1))
    return sorted(out)


def _digests(text: str | None, words: int) -> list[dict]:
    parts = [flat(x) for x in split(text)]
    return [{"at": at, "n": n, "digest": xxhash.xxh3_128_digest("\n".join(x for x, _ in parts[at - 1:at - 1 + n]).encode())}
            for at, n in spans(parts, words)]


def remove(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences, n_removed, removed_at (sentence numbers from 1), kept_text.

    Spans are compared without case and kinds of blanks. A null text has no sentences and stays null; an empty text, or one of fewer
    words, loses nothing; a text of any length is read whole. The first occurrence is the one of the smallest id (none before all),
    then of the smallest hash of the text, then the earliest place, so there are no ties. Rows alike in id and text are one place:
    they do not make each other copies, and all keep or lose the same. Other columns are not read, whatever their names.
    """
    value = F.col(text).cast("string")
    rows = docs.select(F.struct(F.col(key).alias("id"), F.xxhash64(value).alias("hash")).alias("row"), value.alias("text"))
    kind = rows.schema["row"].dataType.simpleString()

    def make_spans():
        def work(batch: pa.RecordBatch) -> dict:
            return {"row": batch.column("row"), "spans": [_digests(x, words) for x in batch.column("text").to_pylist()]}

        return work

    found = map_rows(rows, f"row {kind}, spans array<struct<at:int,n:int,digest:binary>>", make_spans).select("row", F.inline("spans"))
    # A span is one row a task here, however many texts have it. The repeated ones are stored, so that the join below is of two
    # exchanges of its own, of which Spark can split a hot span's: it has one row on this side.
    first = cut(found.groupBy("digest").agg(F.count("*").alias("times"), F.min(F.struct("row", "at")).alias("first"))
                .where("times > 1").select("digest", "first"))
    copies = found.join(first, "digest").where(F.struct("row", "at") != F.col("first"))
    gone = copies.groupBy("row").agg(F.collect_set(F.struct("at", "n")).alias("gone"))

    def make_left():
        def work(batch: pa.RecordBatch) -> dict:
            out = {"doc_id": batch.column("id"), "n_sentences": [], "n_removed": [], "removed_at": [], "kept_text": []}
            for body, covered in zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                parts = split(body)
                removed = {k for x in covered or () for k in range(x["at"], x["at"] + x["n"])}
                out["n_sentences"].append(len(parts))
                out["n_removed"].append(len(removed))
                out["removed_at"].append(sorted(removed))
                out["kept_text"].append("".join(x for k, x in enumerate(parts, 1) if k not in removed) if removed else body)
            return out

        return work

    joined = rows.join(gone, "row", "left").select(F.col("row.id").alias("id"), "text", "gone")
    return map_rows(joined, f"doc_id {dict(joined.dtypes)['id']}, n_sentences bigint, n_removed bigint, removed_at array<int>, kept_text string", make_left)
