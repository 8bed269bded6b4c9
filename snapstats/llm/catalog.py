"""One query for each operator over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapstats.llm import (
    decontaminate, language, lexical_search, licenses, minhash, packing, paragraph_sketch, permuterm, sentences, substrings, token_counts,
    url_filter, warc)
from snapstats.llm.common import ensure_checkpoint_dir, table

WORD_TOKENIZER = "word_bpe_49k.json"
HELD_OUT = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document is benchmark passages, and of which items."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "spans")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after four edits: one half way, an insertion, a deletion, an ending."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.length("text").alias("n")).select(
        "doc_id", "text", F.expr("""array(
            named_struct('start', n div 2, 'end', n div 2 + 20, 'new', upper(substr(text, 1, 20))),
            named_struct('start', n div 4, 'end', n div 4, 'new', ' it\\'s 42 '),
            named_struct('start', 3 * n div 4, 'end', 3 * n div 4 + 10, 'new', ''),
            named_struct('start', n + 100, 'end', n + 100, 'new', substr(text, n div 2, 30)))""").alias("edits"))
    return token_counts.count(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, edits="edits")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated strings of 400 bytes."""
    return substrings.remove(table(spark, sf_dir, "documents")).drop("kept_text")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files in the shared folder, and what reading them back finds."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/warc-{uuid.uuid4()}"
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.records(warc.read_chunks(spark, path))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of at most 2048 tokens."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER)))


def op6_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without sentences of passages that occur before it or earlier in it."""
    return sentences.remove(table(spark, sf_dir, "documents")).drop("removed_at")


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of documents at a similarity of 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85).drop("text_hash")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.where(f"not ({HELD_OUT})").select("doc_id", "text", "lang"))
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.expr(HELD_OUT).alias("held_out"), "lang_pred", "score", "rejected")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, or lines of them, that are known licence texts by their canonical digests."""
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.known_digests(spark))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketch fingerprints of every document and its edited text, and their likeness."""
    return paragraph_sketch.fingerprints(table(spark, sf_dir, "documents"))


# The rules of the query, as (verdict, host, path).
URL_RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
             ("block", "net", "/fr/"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url, by a few rules and the vocabulary."""
    return url_filter.judge(table(spark, sf_dir, "pages"), rules=URL_RULES).drop("terms")


def op12_permuterm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents, its spelling variants, and the form it leads to."""
    return permuterm.variants(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents that score highest for each benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_token_counts": op2_token_counts,
    "op3_substrings": op3_substrings,
    "op4_warc": op4_warc,
    "op5_packing": op5_packing,
    "op6_sentences": op6_sentences,
    "op7_minhash": op7_minhash,
    "op8_language": op8_language,
    "op9_licenses": op9_licenses,
    "op10_fingerprints": op10_fingerprints,
    "op11_url_filter": op11_url_filter,
    "op12_permuterm": op12_permuterm,
    "op13_lexical_search": op13_lexical_search,
}

_CANONICAL = f"regexp_replace(lower(regexp_replace(text, '{licenses.COPYRIGHT}', chr(10), 'g')), '{licenses.DASHES}', ' ', 'g')"
_CANONICAL = f"' ' || regexp_replace({_CANONICAL}, '{licenses.MARKS}', '  ', 'g') || ' '"
for _one, _other in licenses.SPELLINGS:
    _CANONICAL = f"replace({_CANONICAL}, ' {_one.replace(' ', '  ')} ', ' {_other.replace(' ', '  ')} ')"
_CANONICAL = f"trim(regexp_replace({_CANONICAL}, ' +', ' ', 'g'))"
_KNOWN = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in licenses.KNOWN)

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_EDGE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
_SENTENCE, _WORD, _ = sentences.patterns("\\x{{{:X}}}")
_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
_TERMS = ", ".join(f"('{t}', {w})" for t, w in url_filter.TERMS.items())

ORACLE = {
    "op1_decontaminate": r"""
        WITH i AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
                          regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             s AS (SELECT item, w, least(13, len(w)) AS size FROM i WHERE len(w) > 0),
             q AS (SELECT DISTINCT item, size, array_to_string(w[pos + 1:pos + size], ' ') AS words
                   FROM (SELECT item, w, size, unnest(range(0, len(w) - size + 1)) AS pos FROM s)),
             d AS (SELECT doc_id, coalesce(regexp_extract_all(
                              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
             p AS (SELECT doc_id, size, pos, array_to_string(w[pos + 1:pos + size], ' ') AS words
                   FROM (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS pos
                         FROM d, (SELECT DISTINCT size FROM s) WHERE len(w) >= size)),
             m AS (SELECT p.doc_id, p.pos, p.size, q.item FROM p JOIN q USING (size, words)),
             h AS (SELECT doc_id, count(DISTINCT hit) AS n_hit
                   FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS hit FROM m) GROUP BY doc_id),
             o AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN o USING (doc_id)""",
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS data FROM pages),
             d AS (SELECT page_id, CAST(strlen(data) AS BIGINT) AS n, sha1(data) AS hex FROM p),
             t AS (SELECT *, max(page_id) OVER (PARTITION BY hex, n) AS top FROM d)
        SELECT page_id, n AS payload_bytes,
               array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   CAST((CAST('0x' || substr(hex, 5 * i + 1, 5) AS INTEGER) // k) % 32 + 1 AS INTEGER), 1) FOR k IN [32768, 1024, 32, 1]], '')
                   FOR i IN range(0, 8)], '')
                   AS payload_digest,
               CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
        FROM t""",
    "op6_sentences": rf"""
        WITH d AS (SELECT doc_id, text, coalesce(regexp_extract_all(text, '{_SENTENCE}'), []) AS s FROM documents),
             f AS (SELECT doc_id, [trim(regexp_replace(lower(x), '[ \t\n\v\f\r]+', ' ', 'g'), ' ') FOR x IN s] AS s FROM d),
             u AS (SELECT doc_id, pos, len(regexp_extract_all(x, '{_WORD}')) AS n FROM (SELECT doc_id, unnest(s) AS x, generate_subscripts(s, 1) AS pos FROM f)),
             c AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM u),
             j AS (SELECT a.doc_id, a.pos AS start, b.pos AS fin FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.upto - a.upto + a.n >= {sentences.WORDS}),
             r AS (SELECT doc_id, start, min(fin) AS fin FROM j GROUP BY doc_id, start
                   UNION SELECT doc_id, max(start), fin FROM j GROUP BY doc_id, fin),
             k AS (SELECT doc_id, start, fin, row_number() OVER (PARTITION BY array_to_string(s[start:fin], chr(10)) ORDER BY doc_id, start) AS nth FROM r JOIN f USING (doc_id)),
             g AS (SELECT doc_id, list(DISTINCT gone) AS gone FROM (SELECT doc_id, unnest(range(start, fin + 1)) AS gone FROM k WHERE nth > 1) GROUP BY doc_id)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
               CASE WHEN gone IS NULL THEN text
                    ELSE array_to_string([s[n] FOR n IN range(1, len(s) + 1) IF NOT list_contains(gone, n)], '') END AS kept_text
        FROM d LEFT JOIN g USING (doc_id)""",
    "op7_minhash": r"""
        WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, array_to_string(w[pos + 1:pos + 5], ' ') AS shingle
                   FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) AS pos FROM d WHERE len(w) > 0)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
             l AS (SELECT a, b FROM c JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
             reach AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
             m AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least, d.doc_id)) AS component_id,
               d.doc_id <= coalesce(m.least, d.doc_id) AS kept
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id""",
    "op9_licenses": f"""
        WITH k AS (SELECT DISTINCT sha256({_CANONICAL}) AS digest, license FROM (VALUES {_KNOWN}) AS t(license, text)),
             u AS (SELECT doc_id, TRUE AS whole, text FROM documents
                   UNION ALL SELECT doc_id, FALSE, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''),
             f AS (SELECT doc_id, whole, CASE WHEN form <> '' THEN sha256(form) END AS digest FROM (SELECT doc_id, whole, {_CANONICAL} AS form FROM u)),
             m AS (SELECT f.doc_id, f.whole, f.digest, k.license FROM f LEFT JOIN k USING (digest))
        SELECT doc_id, max(CASE WHEN whole THEN digest END) AS digest, min(CASE WHEN whole THEN license END) AS license,
               count(CASE WHEN NOT whole AND license IS NOT NULL THEN 1 END) AS n_notices,
               coalesce(string_agg(DISTINCT license, ',' ORDER BY license), '') AS licenses
        FROM m GROUP BY doc_id""",
    "op10_fingerprints": r"""
        WITH o AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
                          first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS following FROM documents),
             e AS (SELECT *, length(text) AS n, substr(text, 1, length(text) - length(text) // 2) || substr(following, 1, length(text) // 2) AS edited FROM o),
             t AS (SELECT doc_id, 0 AS side, text AS body FROM e UNION ALL SELECT doc_id, 1, edited FROM e UNION ALL SELECT doc_id, 2, following FROM e),
             k AS (SELECT DISTINCT doc_id, side, CAST('0x' || substr(md5(p), 1, 15) AS BIGINT) AS x
                   FROM (SELECT doc_id, side, unnest(regexp_extract_all(body, '[^\n]{PARAGRAPH}[^\n.!?]*[.!?]+|[^\n]+')) AS p FROM t)),
             c AS (SELECT doc_id, side, 8 * h + ((x >> (10 * h)) & 7) AS place, count(*) AS n, bit_xor(x) AS key,
                          bit_xor(((x % 1000003) * 999983 + x // 1000003) % 2147483647) AS chk
                   FROM k, (SELECT unnest([0, 1, 2]) AS h) GROUP BY 1, 2, 3),
             f AS (SELECT doc_id, side, string_agg(coalesce(n || ':' || lower(to_hex(key)) || ':' || lower(to_hex(chk)), '-'), ' ' ORDER BY place) AS printed
                   FROM (SELECT doc_id, side, place FROM t, (SELECT unnest(range(0, 24)) AS place)) LEFT JOIN c USING (doc_id, side, place) GROUP BY 1, 2),
             s AS (SELECT doc_id, side, count(*) AS n FROM k GROUP BY 1, 2),
             b AS (SELECT y.doc_id, y.side, count(*) AS shared FROM k y JOIN k z ON y.doc_id = z.doc_id AND y.x = z.x AND z.side = 0 WHERE y.side > 0 GROUP BY 1, 2),
             j AS (SELECT e.doc_id, q.side, CASE WHEN coalesce(s.n, 0) + coalesce(own.n, 0) = 0 THEN 1.0
                          ELSE CAST(coalesce(shared, 0) AS DOUBLE) / (coalesce(s.n, 0) + coalesce(own.n, 0) - coalesce(shared, 0)) END AS near
                   FROM e CROSS JOIN (SELECT unnest([1, 2]) AS side) q LEFT JOIN s ON s.doc_id = e.doc_id AND s.side = q.side
                   LEFT JOIN s own ON own.doc_id = e.doc_id AND own.side = 0 LEFT JOIN b ON b.doc_id = e.doc_id AND b.side = q.side)
        SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, f0.printed AS fingerprint, f1.printed AS edited_fingerprint,
               j1.near AS near_edited, j2.near AS near_next
        FROM e JOIN f f0 ON f0.doc_id = e.doc_id AND f0.side = 0 JOIN f f1 ON f1.doc_id = e.doc_id AND f1.side = 1
        JOIN j j1 ON j1.doc_id = e.doc_id AND j1.side = 1 JOIN j j2 ON j2.doc_id = e.doc_id AND j2.side = 2""".replace(
            "{PARAGRAPH}", f"{{{paragraph_sketch.PARAGRAPH}}}"),
    "op11_url_filter": rf"""
        WITH r AS (SELECT * FROM (VALUES {_RULES}) AS t(verdict, rule_host, rule_path)), t AS (SELECT * FROM (VALUES {_TERMS}) AS t(term, weight)),
             u AS (SELECT row_number() OVER () AS nr, page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest,
                          ' ' || translate(regexp_replace(coalesce(url, ''), '%[0-9A-Fa-f][0-9A-Fa-f]', ' ', 'g'), {_LOWER}) || ' ' AS plain FROM pages),
             p AS (SELECT nr, page_id, plain, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_LOWER}), '') AS host,
                          coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
             f AS (SELECT nr, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY nr
                          ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC, verdict DESC) AS place
                   FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
             w AS (SELECT nr, CAST(sum(weight) AS BIGINT) AS weight FROM p, t WHERE regexp_matches(plain, '{_EDGE}' || term || '{_EDGE}') GROUP BY nr)
        SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN weight >= {url_filter.LEAST} THEN 'block' ELSE 'allow' END) AS verdict,
               coalesce(weight, 0) AS weight
        FROM p LEFT JOIN (SELECT * FROM f WHERE place = 1) USING (nr) LEFT JOIN w USING (nr)""",
    "op12_permuterm": rf"""
        WITH RECURSIVE bits AS (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
                                FROM (SELECT unnest(range(0, 256)) AS i)),
             crc AS (SELECT list(c ORDER BY i) AS c FROM bits),
             runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
                      FROM documents) GROUP BY ALL),
             h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, [CAST('0x' || x AS BIGINT) FOR x IN regexp_extract_all(
                          hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..')]),
                          lambda k, b: xor(k // 256, c[CAST(xor(k, b) % 256 AS INTEGER) + 1]))) AS h FROM runs, crc),
             w AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word,
                          CAST(sum(n) AS BIGINT) AS n FROM h GROUP BY 1),
             v AS (SELECT word, n FROM w WHERE length(word) >= 6 AND n >= 5),
             d AS (SELECT DISTINCT word, n, length(word) AS size, pos, substr(word, 1, pos - 1) || substr(word, pos + 1) AS less
                   FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM v)),
             e AS (SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.less = b.less AND a.pos = b.pos AND a.size = b.size AND a.word <> b.word
                   UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.less = v.word
                   UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.less = v.word),
             g AS (SELECT word, count(*) AS n_near, max(near_n) AS top_n FROM e GROUP BY word),
             f AS (SELECT e.word, min(near) AS top, any_value(top_n) AS top_n, any_value(n_near) AS n_near FROM e JOIN g ON e.word = g.word AND e.near_n = g.top_n GROUP BY e.word),
             o AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * n THEN top END AS form, CASE WHEN top_n >= 5 * n THEN top_n END AS form_n
                   FROM v LEFT JOIN f USING (word)),
             s AS (SELECT word, word AS root, 0 AS step FROM o UNION ALL SELECT s.word, o.form, step + 1 FROM s JOIN o ON s.root = o.word WHERE o.form IS NOT NULL)
        SELECT o.word, n, n_near, form, form_n, root FROM o JOIN (SELECT word, arg_max(root, step) AS root FROM s GROUP BY word) USING (word)""",
    "op13_lexical_search": rf"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS nr, regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
             c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
             i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
             q AS (SELECT nr, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT nr, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
             w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM q, c GROUP BY term, docs),
             s AS (SELECT item_id, nr, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * CAST(len(t) AS BIGINT) * docs) // terms)))) AS BIGINT) AS score
                   FROM q JOIN w USING (term) JOIN i USING (term) JOIN d USING (nr), c GROUP BY item_id, nr),
             r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s JOIN d USING (nr) WHERE score > 0)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50""",
}
