"""URL filter, spelling variants and ranked search against brute force, on awkward rows."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from snapstats.llm import lexical_search, permuterm, url_filter

LOWER = {c: c + 32 for c in range(65, 91)}


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


# 11

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "b.org", ""), ("allow", "b.org", ""),
         ("block", "a.b.org", "/x"), ("allow", "b.org", "/xyz"))
URLS = [None, "", "no scheme/porn", "http://", "://", "HTTP://WWW.Example.COM/en/x?y#z", "http://sub.example.com/en/x", "http://notexample.com/en/x",
        "http://example.com/EN/x", "http://example.com", "http://example.com?a=/en/", "http://example.com#/en/", "http://a.b.org/xyz", "http://b.org/xyz",
        "http://c.net/free/free", "http://c.net/free-Girls", "http://freegirls.net/", "http://c.net/PORN", "http://c.net/pörnporn", "http://c.net/éporn",
        "http://c.net/%20porn%20", "http://c.net/porn1", "http://porn.c.net", "http://x.net/a://b/c", "http://c.net/hot_hot_hot", "http://c.net/free?x=bet#cams",
        "http://c.net:80/x", "http://u@c.net/x", "http://..com/", "http://c.net/" + "long/" * 40000 + "hentai", "http://é.com/x"]


def brute_url(url, rules, terms, least):
    m = re.match(r"(?s)(?:.*?)://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fits = [(len(h) + len(p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    text = re.sub("%[0-9A-Fa-f]{2}", " ", url or "").translate(LOWER)
    edge = r"[^a-z0-9\x80-\U0010ffff]"
    weight = sum(w for t, w in terms.items() if re.search(f"(?:^|{edge}){t}(?:$|{edge})", text))
    _, _, verdict, rule = max(fits, default=(0, 0, "block" if weight >= least else "allow", None))
    return host, path, rule, verdict, weight


def test_url_filter(sc):
    pages = sc.createDataFrame([(n, u, "h") for n, u in enumerate(URLS)] + [(5, URLS[5], "h"), (None, URLS[17], None)],
                               "page_id bigint, url string, terms string").withColumn("host", F.lit("z"))
    got = rows(url_filter.judge(pages, rules=RULES), "page_id", "host", "path", "rule", "verdict", "weight")
    want = [(r["page_id"], *brute_url(r["url"], RULES, url_filter.TERMS, 2)) for r in pages.collect()]
    assert got == sorted(want, key=repr)
    verdicts = {URLS[n]: v for n, *_, v, _ in got if n is not None}
    assert verdicts["http://c.net/free/free"] == "allow" and verdicts["http://c.net/free-Girls"] == "block"  # several distinct soft words
    assert verdicts["http://c.net/%20porn%20"] == "block" and verdicts["http://c.net/pörnporn"] == "allow"
    assert url_filter.judge(pages.where("1 = 0")).count() == 0
    alone = url_filter.judge(pages, terms={})
    assert alone.where("verdict = 'block' or rule is not null").count() == 0


def test_url_filter_limits(sc):
    pages = sc.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    with pytest.raises(ValueError):
        url_filter.judge(pages, rules=[("allow", "x" * url_filter.LIST_CHARS, "/y")])
    with pytest.raises(Exception, match="no such verdict"):
        url_filter.judge(pages, rules=[("maybe", "a.b", "/")]).collect()


# 12

def edits(word, other):
    """Whether two different words are one edit apart."""
    if len(word) == len(other):
        return sum(a != b for a, b in zip(word, other, strict=True)) == 1
    short, long = sorted((word, other), key=len)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_variants(docs, one_in, least_length, least_count):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % one_in == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}
    form, near = {}, {w: [x for x in words if edits(w, x)] for w in words}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    out = []
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out.append((w, words[w], len(near[w]), form.get(w), words.get(form.get(w)), root))
    return sorted(out, key=repr)


NAMES = ("word", "n", "n_near", "form", "form_n", "root")


@pytest.mark.parametrize(("one_in", "least_length", "least_count"), [(199, 6, 5), (7, 3, 1), (1, 1, 2)])
def test_variants(sc, awkward, one_in, least_length, least_count):
    small = awkward.where("doc_id is null or doc_id <> 7")
    # Rows of equal letters, chains of forms, ties, letters at the edge of the class, a hub, edits at either end.
    extra = [(900, "aabbaa " * 125), (901, "aabaa " * 25), (902, "abaa " * 5), (903, "aabbab Aabbac " * 4), (904, "àëîõû \u00d7\u00f7\u00ffabc ÀËÎÕÛ"),
             (905, "kernel " * 200 + "kernels ckernel kernl ernel kerne kernell kkernel " * 3), (906, "abcdef abcdeg abcdeh bbcdef " * 2)]
    docs = small.select("doc_id", "text", "key", "n").unionByName(
        sc.createDataFrame(extra, "doc_id bigint, text string").withColumns({"key": F.lit("z"), "n": F.lit("z")}))
    got = permuterm.variants(docs, one_in=one_in, least_length=least_length, least_count=least_count)
    want = brute_variants([(r["doc_id"], r["text"]) for r in docs.collect()], one_in, least_length, least_count)
    assert rows(got, *NAMES) == want
    if least_count == 1:
        assert any(r[5] != (r[3] or r[0]) for r in want)  # a chain of two forms


def test_variants_of_nothing(sc, none):
    assert permuterm.variants(none).count() == 0
    assert rows(permuterm.variants(sc.createDataFrame([(1, "lonely " * 7)], "doc_id int, text string"), one_in=None), *NAMES) \
        == [("lonely", 7, 0, None, None, "lonely")]


def test_tasks_hand_on_sums(sc, monkeypatch):
    docs = sc.range(20).selectExpr("id as doc_id", "concat('wordsand', repeat('x', int(id % 4)), ' other') as text").coalesce(2)
    monkeypatch.setattr(permuterm, "HELD_WORDS", 2)
    assert rows(permuterm.count(docs, one_in=None, least_length=5, least_count=5), "word", "n") == sorted(
        [("wordsand" + "x" * k, 5) for k in range(4)] + [("other", 20)], key=repr)


# 13

def brute_search(docs, items, top):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    bags = [(d, Counter(words(t))) for d, t in docs]
    bags = [x for x in bags if x[1]]
    terms, total = {}, sum(sum(b.values()) for _, b in bags)
    for item, text in items:
        terms.setdefault(item, set()).update(words(text))
    out = []
    for item, wanted in terms.items():
        found = []
        for doc, bag in bags:
            m, score = 50 + 50 * sum(bag.values()) * len(bags) // total, 0
            for t in wanted & set(bag):
                df = sum(t in b for _, b in bags)
                score += math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("top", "block_chars", "parts"), [(3, 1 << 20, 64), (5, 60, 1), (50, 1 << 20, 2)])
def test_search(sc, awkward, prose, top, block_chars, parts, monkeypatch):
    monkeypatch.setattr(lexical_search, "PARTS", parts)
    s = prose(400, 1)
    items = [(1, " ".join(s[20:24])), (2, "ONE, two"), (3, None), (4, "?!"), (None, s[100]), (5, s[85]), (5, "one twö"), (6, "é€𝄞"), (7, "nowhere7at all"), (8, "")]
    benchmark = sc.createDataFrame(items, "item_id bigint, text string").withColumn("score", F.lit("z"))
    got = lexical_search.search(awkward.repartition(3), benchmark, top=top, block_chars=block_chars)
    docs = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert rows(got, "item_id", "rank", "doc_id", "score") == brute_search(docs, items, top)


def test_search_ties_and_overlaps(sc):
    docs = sc.createDataFrame([(k, "a a a b") for k in range(40, 0, -1)] + [(None, "a a a b"), (77, "c d")], "doc_id int, text string").repartition(4)
    benchmark = sc.createDataFrame([("x", "A b"), ("y", "a")], "item_id string, text string")
    got = lexical_search.search(docs, benchmark, top=10).where("item_id = 'x'").orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == list(range(1, 11)) and len({r["score"] for r in got}) == 1
    assert lexical_search.spaced("x\x85y,z\u00a0") == (" x\x85y z\u00a0 ", 2)
    assert lexical_search.occurrences(lexical_search.automaton(["a", "a1", "b"]), lexical_search.spaced("A a,a1 Aa b\x00a\u2003a")[0]) == {0: 2, 1: 1, 2: 1}  # a wide space belongs to its word


def test_search_of_nothing(sc, none, awkward):
    benchmark = sc.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical_search.search(none, benchmark).count() == 0
    assert lexical_search.search(awkward, benchmark.where("1 = 0")).count() == 0
