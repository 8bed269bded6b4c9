"""License scans by canonical digest: a text's wording, without its dress, is looked up among known licences.

The canonical form folds case, equivalent spellings, quotation marks and dashes, drops lines that name an owner, a
leading title and punctuation, and has single blanks. The digests of a whole text and of its lines are joined to the
digests of known texts, those of its paragraphs to the paragraphs of known texts, which must follow each other whole.
That table is small and fixed, so documents are not shuffled for the lookup.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Licence ids and texts by which they are granted.
KNOWN = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, version 2.0."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to
use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom
the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
]
# Spellings read as one.
SPELLINGS = [("licence", "license"), ("licenced", "licensed"), ("sub license", "sublicense"), ("non commercial", "noncommercial"),
             ("merchantibility", "merchantability"), ("copyright holder", "copyright owner"), ("per cent", "percent"),
             ("acknowledgement", "acknowledgment"), ("organisation", "organization"), ("favour", "favor"), ("https", "http")]

# What the SQL takes for a line that names an owner; the operator asks for more (OWNER), as this drops wording, too.
# This regular expression and MARKS read alike in Java and in RE2.
COPYRIGHT = r"(?i)(^|\n)[ \t#*/;]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
MARKS = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
DASHES = "[‐-―‘-‟]"


# A line that names an owner: copyright with a mark, a year, a blank to fill in, or a name, which begins with a capital and
# is no word of the licences themselves (in capitals throughout, wording and names look alike); a mark with a year; a line of reserved rights.
WORDING = r"(?i:and|are|as|but|by|claims?|disclaimers?|for|grants?|holders?|if|in|infringement|interests?|is|laws?|licen[cs]e[ds]?|licen[cs]ing|" \
          r"may|messages?|must|notices?|of|on|or|owners?|ownership|permission|protection|rights?|shall|statements?|subsists|terms|that|the|" \
          r"this|to|treaty|treaties|under|which|will|with)"
OWNER = r"(?m)^[ \t#*/;]*(?:(?i:copyright)[ \t,:]*(?:(?i:\(c\)|©|&copy;)|[0-9]{4}|[\[<{])|" \
        rf"[Cc]opyright[ \t,:]+(?:by[ \t]+|[Tt]he[ \t]+)?(?!{WORDING}\b)\p{{Lu}}|" \
        r"(?i:\(c\))[ \t]*(?:(?i:copyright)[ \t]*)?[0-9]{4}|©|(?i:all rights reserved))[^\n]*"
# A title above the wording; a text that is a title only keeps it.
TITLE = r"(?i)\A[\s#*/;=-]*(?:the[ \t]+)?(?:(?:modified|new|revised|simplified)[ \t]+)?" \
        r"(?:(?:MIT|ISC|(?:BSD[ \t]+)?[23]-Clause|BSD)(?:[ \t]+BSD)?(?:[ \t]+[23]-Clause)?)(?:[ \t]*/[ \t]*X11)?[ \t]+licen[cs]e" \
        r"(?:[ \t]*\([A-Za-z0-9 -]+\))?[ \t\r#*/;=:-]*\n(?=[\s\S]*[\p{L}0-9])"
BLANK = r"\n[ \t\r#*/;]*\n"
# MARKS and DASHES after lower-casing, but for line breaks.
GAPS = rf"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F{DASHES[1:-1]}]+"


def _spelled(words, spellings) -> F.Column:
    for one, other in spellings:
        words = F.replace(words, F.lit(f" {one.replace(' ', '  ')} "), F.lit(f" {other.replace(' ', '  ')} "))
    return words


def _words(text) -> F.Column:
    """The words of a text in one spelling, line by line; two blanks are between them, so that each has blanks of its own."""
    out = F.replace(F.regexp_replace(F.lower(text), GAPS, "  "), F.lit("\n"), F.lit("  \n  "))
    return _spelled(F.concat(F.lit(" "), out, F.lit(" ")), SPELLINGS)


def _single(words) -> F.Column:
    return F.trim(F.replace(words, F.lit("  "), F.lit(" ")))


def _joined(words) -> F.Column:
    """Lines of ``_words`` as one; spellings of several words may have met a line break."""
    return _single(_spelled(F.regexp_replace(words, " *\n[ \n]*", "  "), [x for x in SPELLINGS if " " in x[0]]))


def _digest(form) -> F.Column:
    """Of a form at hand: a computed one would be computed again for the comparison."""
    return F.when(form != "", F.sha2(form, 256))


def canonical(text) -> F.Column:
    """The wording of a text in one form; null for a null text, empty when no words are left."""
    return _joined(_words(F.regexp_replace(F.regexp_replace(text, OWNER, ""), TITLE, "")))


def digest(text) -> F.Column:
    """Digest of the canonical form; null where there are no words."""
    return F.transform(F.array(canonical(text)), _digest)[0]


def known_texts() -> list[tuple[str, str]]:
    """``KNOWN`` and the full texts beside this module: (license, text). Texts with terms of use behind them count without these, too."""
    out = list(KNOWN)
    for file in sorted(resources.files("snapstats.llm").joinpath("known").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt").split("~")[0], file.read_text("utf-8")
        out.append((name, text))
        if (end := re.search("END OF TERMS AND CONDITIONS", text)) is not None:
            out += [(name, text[:end.start()]), (name, text[:end.end()])]
        if name.startswith("BSD"):  # the conditions without numbers
            out.append((name, re.sub(r"(?m)^\d\. ", "* ", text)))
    return out


def paragraphs(text) -> F.Column:
    """(digest, several): the paragraphs of a text that have words, and whether they are of several lines."""
    parts = F.transform(F.split(F.regexp_replace(text, OWNER, ""), BLANK),
                        lambda x: F.struct(canonical(x).alias("form"), F.trim(x, F.lit(" \t\r\n")).contains("\n").alias("several")))
    parts = F.transform(parts, lambda x: F.struct(_digest(x["form"]).alias("digest"), x["several"].alias("several")))
    return F.filter(parts, lambda x: x["digest"].isNotNull())


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(digest, license, paragraphs): the table of known texts with the digests of their paragraphs; repeated texts of one licence are one row."""
    table = spark.createDataFrame(known_texts() if known is None else known, "license string, text string")
    parts = F.transform(paragraphs(F.regexp_replace(F.regexp_replace("text", OWNER, ""), TITLE, "")), lambda x: x["digest"])
    return table.select(digest(F.col("text")).alias("digest"), "license", parts.alias("paragraphs")).where("digest is not null").distinct()


def lookup(known: DataFrame) -> DataFrame:
    """(digest, part, names, passage, n, number): whole known texts with all their licences, and the paragraphs of each."""
    whole = known.groupBy("digest").agg(F.sort_array(F.collect_set("license")).alias("names"))
    parts = known.select("license", F.array_join("paragraphs", ",").alias("passage"), F.size("paragraphs").alias("n"), F.posexplode("paragraphs").alias("number", "digest"))
    parts = parts.select("digest", F.lit(True).alias("part"), F.array("license").alias("names"), F.sha2("passage", 256).alias("passage"), "n", "number").distinct()
    return whole.select("digest", F.lit(False).alias("part"), "names", F.lit(None).cast("string").alias("passage"), F.lit(0).alias("n"),
                        F.lit(0).alias("number")).unionByName(parts)


def scan(docs: DataFrame, known: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, digest (of the whole text), license (of the whole text), n_notices and
    licenses (sorted ids of the whole text and of all lines, and paragraphs one after the other, that are known
    texts themselves, comma-joined).

    A null text, or one without words, has no digest and matches nothing. A digest known for several licences
    names all of them; ``license`` is the first by name. Rows are judged one by one; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    unit = lambda part, at, digest, several: F.struct(
        F.lit(part).alias("part"), F.lit(at).cast("int").alias("at"), digest.alias("digest"), several.alias("several"))
    # Owners are dropped and words are found once, for the whole text and its lines; only a text with a title differs as a whole.
    rows = rows.withColumn("rest", F.regexp_replace("text", OWNER, "")).withColumn("words", _words(F.col("rest")))
    rows = rows.withColumn("digest", F.when(F.col("rest").rlike(TITLE), digest(F.col("text"))).otherwise(
        F.transform(F.array(_joined(F.col("words"))), _digest)[0]))
    lines = F.transform(F.transform(F.split(F.coalesce("words", F.lit("")), "\n"), _single), _digest)
    inner = F.when(F.col("text").rlike(BLANK), paragraphs(F.col("text")))  # one paragraph is the whole text
    units = rows.select("row", "doc_id", F.explode(F.concat(
        F.array(unit(False, -1, F.col("digest"), F.lit(True))),
        F.transform(F.filter(lines, lambda x: x.isNotNull()), lambda x: unit(False, 0, x, F.lit(False))),
        F.coalesce(F.transform(inner, lambda x, n: unit(True, n, x["digest"], x["several"])), F.array().cast(
            "array<struct<part:boolean,at:int,digest:string,several:boolean>>")))).alias("x")).select("row", "doc_id", "x.*")
    found = units.join(lookup(known), ["digest", "part"], "left").where("at < 0 or names is not null").withColumn("whole", F.col("at") < 0)
    # All paragraphs of a known text, one after the other; a paragraph of one line has been looked up as a line.
    found = found.groupBy("row", "part", "whole", "names", "passage", "n", (F.col("at") - F.col("number")).alias("start")).agg(
        F.max("doc_id").alias("doc_id"), F.max("digest").alias("digest"), F.max("several").alias("several"), F.count("*").alias("met"))
    return found.where("not part or (met = n and (n > 1 or several))").groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max(F.when(F.col("whole"), F.col("digest"))).alias("digest"),
        F.max(F.when(F.col("whole"), F.col("names")[0])).alias("license"),
        F.coalesce(F.sum(F.when(~F.col("whole") & ~F.col("part"), F.col("met"))), F.lit(0).cast("bigint")).alias("n_notices"),
        F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("names")))), ",").alias("licenses")).drop("row")
