"""Token counts that follow edits: a segment tree of pre-tokens for each document.

A byte-level BPE encodes every pre-token by itself, so a document's count is the sum over its pre-tokens. The
tree holds blocks of pre-tokens at its leaves and sums of characters and tokens above. An edit finds its place
by the character sums, splits only the touched region and some context into pre-tokens again, stops where
the new boundaries meet the old ones, encodes the new pre-tokens, and updates the sums on the way to the root.
"""

from __future__ import annotations

import base64
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import map_rows

#: Pre-tokens in a block when a tree is built; a block four times as large makes the tree anew.
BLOCK = 128
#: A pre-token's match looks at no more characters behind its own end than these ("'l" before "l", a blank before a word).
LOOK_AHEAD = 2
CACHE_WORDS, CACHE_CHARS = 500_000, 64

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # the Unicode property, unlike \s
#: Pre-tokens never go on from other characters into white space, so words with a blank before them stand alone.
_CHUNK = re.compile(rf" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_counters: dict = {}


class Counter:
    """Pre-tokens of a text and tokens of each; counts of frequent pre-tokens are remembered."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.known: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}

    def tokens(self, part: str) -> int:
        return len(self.encoding.encode_ordinary(part))

    def split(self, text: str) -> tuple[list[int], list[int]]:
        """(characters, tokens) of the pre-tokens of a text."""
        chunks, known = _CHUNK.findall(text), self.known
        new = {x for x in set(chunks) if x not in known}
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set(chunks)
        for chunk in new:
            parts = self.pattern.findall(chunk)
            known[chunk] = tuple(map(len, parts)), tuple(map(self.tokens, parts))
        found = list(map(known.__getitem__, chunks))
        for chunk in new:
            if len(chunk) > CACHE_CHARS:
                del known[chunk]
        return list(chain.from_iterable(x for x, _ in found)), list(chain.from_iterable(x for _, x in found))


class Tree:
    """Sums of characters and tokens over blocks of pre-tokens."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self.build(lengths, counts)

    def build(self, lengths: list[int], counts: list[int]) -> None:
        cuts = range(0, max(1, len(lengths)), BLOCK)
        self.lengths = [lengths[i:i + BLOCK] for i in cuts]
        self.counts = [counts[i:i + BLOCK] for i in cuts]
        self.size = 1 << (len(self.lengths) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.size), [0] * (2 * self.size)
        for n in range(len(self.lengths)):
            self.chars[self.size + n], self.tokens[self.size + n] = sum(self.lengths[n]), sum(self.counts[n])
        for node in range(self.size - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, at: int) -> tuple[int, int, int]:
        """(block, place in it, start) of the last pre-token that starts at ``at`` or before."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if start + self.chars[node] <= at and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        block, place = node - self.size, 0
        lengths = self.lengths[block]
        while place + 1 < len(lengths) and start + lengths[place] <= at:
            start += lengths[place]
            place += 1
        return block, place, start

    def replace(self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], counts: list[int]) -> None:
        """Put new pre-tokens in place of those from ``first`` up to ``last`` (block, place), without it."""
        (block, place), (to, end) = first, last
        if block == to:
            self.lengths[block][place:end] = lengths
            self.counts[block][place:end] = counts
        else:
            self.lengths[block][place:] = lengths
            self.counts[block][place:] = counts
            for n in range(block + 1, to):
                self.lengths[n], self.counts[n] = [], []
            del self.lengths[to][:end], self.counts[to][:end]
        if len(self.lengths[block]) > 4 * BLOCK:
            self.build([x for b in self.lengths for x in b], [x for b in self.counts for x in b])
            return
        for n in range(block, to + 1):
            self.chars[self.size + n], self.tokens[self.size + n] = sum(self.lengths[n]), sum(self.counts[n])
        lo, hi = (self.size + block) // 2, (self.size + to) // 2
        while lo:
            for node in range(lo, hi + 1):
                self._sum(node)
            lo, hi = lo // 2, hi // 2


class Document:
    """A text, its tree, and how many pre-tokens edits have made the encoder look at."""

    def __init__(self, counter: Counter, text: str):
        self.counter, self.text, self.encoded = counter, text, 0
        self.tree = Tree(*counter.split(text))

    @property
    def n_tokens(self) -> int:
        return self.tree.tokens[1]

    @property
    def n_pretokens(self) -> int:
        return sum(map(len, self.tree.lengths))

    def edit(self, start: int, end: int, new: str) -> None:
        """Replace the characters from ``start`` up to ``end``; places beyond the text mean its end."""
        start = min(max(start, 0), len(self.text))
        end = min(max(end, start), len(self.text))
        tree, shift = self.tree, len(new) - (end - start)
        self.text = self.text[:start] + new + self.text[end:]
        block, place, at = tree.find(max(0, start - LOOK_AHEAD))
        to, there, old = block, place, at  # walks over the old pre-tokens
        parts = []
        for match in self.counter.pattern.finditer(self.text, at):
            begin = match.start()
            if begin >= start + len(new):
                while old < begin - shift:
                    while there == len(tree.lengths[to]):
                        to, there = to + 1, 0
                    old += tree.lengths[to][there]
                    there += 1
                if old == begin - shift and old >= end:
                    break
            parts.append(match.group())
        else:
            to = len(tree.lengths) - 1
            there = len(tree.lengths[to])
        self.encoded += len(parts)
        tree.replace((block, place), (to, there), list(map(len, parts)), list(map(self.counter.tokens, parts)))


def counter(path: str, pattern: str) -> Counter:
    """One counter for each Python worker and vocabulary."""
    if (path, pattern) not in _counters:
        _counters.clear()
        _counters[path, pattern] = Counter(path, pattern)
    return _counters[path, pattern]


def count(docs: DataFrame, ranks: str, pattern: str, *, key: str = "doc_id", text: str = "text",
          edits: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_pretokens, n_tokens, and after the edits n_tokens_edited, n_reencoded.

    ``edits`` names an array of (start, end, new) structs, applied one after another, each to the text that the
    one before left; places count characters. A null text is empty; a null array, edit, place or new text
    edits nothing (null places: 0, null text: a deletion). Without edits both counts are equal. A document is
    counted where it lies: nothing is shuffled.
    """
    kind = dict(docs.dtypes)[key]
    edit = F.col(edits) if edits else F.array()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"),
                       edit.cast("array<struct<start:int,end:int,new:string>>").alias("edits"))

    def make():
        known = counter(ranks, pattern)

        def work(batch: pa.RecordBatch) -> dict:
            out = {k: [] for k in ("n_pretokens", "n_tokens", "n_tokens_edited", "n_reencoded")}
            for value, changes in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist(), strict=True):
                doc = Document(known, value or "")
                out["n_pretokens"].append(doc.n_pretokens)
                out["n_tokens"].append(doc.n_tokens)
                for change in changes or ():
                    if change:
                        doc.edit(change["start"] or 0, change["end"] or 0, change["new"] or "")
                out["n_tokens_edited"].append(doc.n_tokens)
                out["n_reencoded"].append(doc.encoded)
            return out | {"doc_id": batch.column("key")}

        return work

    return map_rows(rows, f"doc_id {kind}, n_pretokens bigint, n_tokens bigint, n_tokens_edited bigint, n_reencoded bigint", make)
