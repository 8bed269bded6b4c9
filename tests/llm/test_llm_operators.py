"""Operators against brute force, on awkward documents: nulls, empty and long texts, ties, repeats, clashing names."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapstats.llm import (
    components, decontaminate, language, licenses, minhash, packing, paragraph_sketch, sentences, substrings, token_counts, warc)

from snapstats.llm.catalog import QUERIES
from snapstats.llm.common import cut

ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


# 1

def brute_hits(docs, items, window):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(ASCII_LOWER))
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            i = words(body)
            size = min(window, len(i))
            for k in range(len(i) - size + 1 if i else 0):
                for at in range(len(w) - size + 1):
                    if w[at:at + size] == i[k:k + size]:
                        hit |= set(range(at, at + size))
                        found |= {item} - {None}
        ids = sorted(map(str, found))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontaminate(sc, awkward, prose, block_bytes):
    s = prose(400, 1)
    items = [(1, " ".join(s[20:24])), (2, "ONE, two"), (3, None), (4, "?!"), (None, s[100]), (5, s[85] + " " + s[86]), (5, "one two"), (30, "é")]
    benchmark = sc.createDataFrame(items, "item_id bigint, text string").withColumn("key", F.lit("z"))
    small = awkward.where("doc_id is null or doc_id <> 7")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = decontaminate.find(small, benchmark, window=6, block_bytes=block_bytes)
    assert rows(got, *names) == brute_hits(texts(small), items, 6)
    for r in got.join(small.where("doc_id = 13").select("doc_id", "text").distinct(), "doc_id").collect():
        assert [r["text"][x["start"]:x["end"]] for x in r["spans"]] == ["one two"]
    left = decontaminate.clean(small, benchmark, window=6)
    assert left.columns == awkward.columns
    assert left.count() == got.where("not contaminated").count()


def test_decontaminate_empty(awkward, none, sc):
    benchmark = sc.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert decontaminate.find(none, benchmark).count() == 0
    assert decontaminate.find(awkward, benchmark.where("1 = 0")).where("n_hit > 0").count() == 0


# 2

def encoding():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_follow_edits():
    known, encode, rng = token_counts.Counter(RANKS, public_tokenizers.PATTERN), encoding().encode_ordinary, random.Random(3)
    letters = ["a", "'", "l", " ", "\n", "ll", "9", "é", "...", "  ", "\x1c", "\xa0", "x y"]
    for turn in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40))) * rng.choice([1, 1, 60])
        doc = token_counts.Document(known, text)
        assert doc.n_tokens == len(encode(text))
        for _ in range(5):
            a = rng.randrange(len(text) + 1)
            b, new = min(len(text), a + rng.randrange(6)), "".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 700 if turn % 50 == 0 else 1])))
            doc.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert (doc.text, doc.n_tokens) == (text, len(encode(text)))
        assert [x for block in doc.tree.lengths for x in block] == [len(m) for m in known.pattern.findall(text)]


def test_token_counts(awkward, none):
    edited = awkward.withColumn("edits", F.expr("""case when doc_id in (7, 8) then array(
        named_struct('start', 100, 'end', 120, 'new', 'abc'), cast(null as struct<start:int,end:int,new:string>),
        named_struct('start', 9000000, 'end', 0, 'new', ' the end')) end"""))
    encode = encoding().encode_ordinary
    want = []
    for doc, text in texts(awkward):
        text = text or ""
        new = text[:100] + "abc" + text[120:] + " the end" if doc in (7, 8) else text
        want.append((doc, len(encode(text)), len(encode(new))))
    got = token_counts.count(edited, RANKS, public_tokenizers.PATTERN, edits="edits")
    assert rows(got, "doc_id", "n_tokens", "n_tokens_edited") == sorted(want, key=repr)
    assert max(r["n_reencoded"] for r in got.collect()) < 40
    assert token_counts.count(none, RANKS, public_tokenizers.PATTERN).count() == 0


# 3

def brute_spans(data, length):
    seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                flags[i:i + length] = True
        out.append(flags)
    return out


def brute_copies(docs, length):
    """Bytes under a string that also starts before (rows in the order given), and under none that is the first of its kind."""
    count = collections.Counter(d[i:i + length] for d in docs for i in range(len(d) - length + 1))
    seen, out = set(), []
    for d in docs:
        gone, kept = np.zeros(len(d), bool), np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            x = d[i:i + length]
            if x in seen:
                gone[i:i + length] = True
            elif count[x] > 1:
                kept[i:i + length] = True
            seen.add(x)
        out.append(gone & ~kept)
    return out


@pytest.mark.parametrize("batch_bytes", [1 << 20, 300])
def test_first_of_repeated_strings_stays(sc, prose, monkeypatch, batch_bytes):
    monkeypatch.setattr(substrings, "BATCH_BYTES", batch_bytes)
    s, rng = prose(300, 19), random.Random(14)
    shared = "".join(s[:6])
    made = [(k, s[10 + k] + shared[rng.randrange(60):len(shared) - rng.randrange(60)] + s[60 + k]) for k in range(30)]
    made += [(100 + k, shared[:50 + 7 * k] + "Z" + shared[50 + 7 * k:]) for k in range(20)]
    made += [(200, "x" * 900), (201, "é€𝄞\n" * 100), (202, s[90] + "x" * 300 + s[91]), (203, ""), (204, None), (205, s[120] + s[121]), (206, s[122]),
             (207, s[100] + s[101] + s[102] + s[103]), (208, s[101] + s[102] + s[103] + s[104]), (209, s[102] + s[103] + s[104] + s[105]), (5000, "".join(s[:80]))]
    docs = sc.createDataFrame(made, "doc_id bigint, text string").withColumns({"later": F.lit("z"), "piece": F.lit("z")})
    got = {r["doc_id"]: r["text"] for r in substrings.clean(docs, length=100, keep_first=True).collect()}
    data = [(t or "").encode() for _, t in made]
    want = {d: t and bytes(np.frombuffer(x, np.uint8)[~gone]).decode(errors="ignore")
            for (d, t), x, gone in zip(made, data, brute_copies(data, 100), strict=True)}
    assert got == want and got[205] == made[-6][1] and sum(len(t or "") for t in got.values()) < 0.6 * sum(map(len, data))
    # Of 900 equal letters the first string stays.
    assert sum((t or "").count("x" * 100) for t in got.values()) == 1
    # Rows alike in id and text are one row; a row without id comes first.
    twice = sc.createDataFrame([(1, shared), (1, shared), (2, shared), (None, shared)], "doc_id bigint, text string")
    assert rows(substrings.clean(twice, length=100, keep_first=True), "doc_id", "text") == sorted([(None, shared), (1, ""), (1, ""), (2, "")], key=repr)
    assert substrings.clean(docs.where("1 = 0"), keep_first=True).count() == 0


@pytest.mark.parametrize("batch_bytes", [1 << 20, 300])
def test_substrings(sc, awkward, none, prose, monkeypatch, batch_bytes):
    monkeypatch.setattr(substrings, "BATCH_BYTES", batch_bytes)  # small: anchors are refined
    s, rng = prose(300, 9), random.Random(4)
    shared = "".join(s[:6])
    made = [(100 + k, s[10 + k][:rng.randrange(40)] + shared[rng.randrange(30):len(shared) - rng.randrange(30)] + s[60 + k]) for k in range(40)]
    made += [(200 + k, shared[:50 + 7 * k] + "Z" + shared[50 + 7 * k:]) for k in range(20)]
    docs = awkward.unionByName(sc.createDataFrame(made, "doc_id bigint, text string"), allowMissingColumns=True)
    all_texts = [(doc, (text or "").encode()) for doc, text in texts(docs)]
    want = []
    for (doc, data), gone in zip(all_texts, brute_spans([d for _, d in all_texts], 100), strict=True):
        runs = int(gone[:1].sum() + (np.diff(gone.astype(int)) == 1).sum())
        left = bytes(np.frombuffer(data, np.uint8)[~gone])
        want.append((doc, len(data), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    got = substrings.remove(docs, length=100)
    assert rows(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=repr)
    assert substrings.clean(docs, length=100).columns == docs.columns
    assert substrings.remove(none).count() == 0


def test_repeated_places_are_gathered_as_ranges(sc, prose):
    """A copy between other words is compared place by place, but it is one range of its row, not one for each of its places."""
    s = prose(200, 53)
    passage, length = " ".join(s[:12]), 100
    docs = {n: f"{s[20 * n]} {passage} {s[20 * n + 1]}{' ' + passage if n == 3 else ''}" for n in (1, 2, 3, 4)}
    frame = sc.createDataFrame([*docs.items()], "doc_id bigint, text string")
    parts, pieces = substrings._repeated(frame, "doc_id", "text", length)
    starts = cut(substrings._settled(parts, pieces, length))
    got = {r["row"]["id"]: [(x["start"], x["end"]) for x in r["later"]] for r in substrings._later(pieces, starts, length).collect()}
    seen, want = set(), {}
    for d, text in docs.items():
        for at in range(len(text) - length + 1):
            if text[at:at + length] in seen:
                want.setdefault(d, set()).add(at)
            seen.add(text[at:at + length])
    assert {d: {at for a, b in ranges for at in range(a, b)} for d, ranges in got.items()} == want
    assert all(b < a for ranges in got.values() for (_, b), (a, _) in zip(ranges, ranges[1:]))
    assert {d: len(x) for d, x in got.items()} == {2: 1, 3: 2, 4: 1}


def test_strings_of_long_pieces_come_in_bounded_batches(prose, monkeypatch):
    monkeypatch.setattr(substrings, "PLACES", 500)
    texts, length = [" ".join(prose(n, n)).encode() for n in (60, 3, 40)], 100
    wanted = [[{"start": a, "strings": min(64, len(t) - length + 1 - a)} for a in range(0, len(t) - length + 1, 64)] for t in texts]
    batch = pa.RecordBatch.from_pylist([{"row": {"id": n, "hash": 7}, "piece": 10 * n, "data": t, "wanted": w}
                                        for n, (t, w) in enumerate(zip(texts, wanted, strict=True))])
    made = [pa.table(x).to_pylist() for x in substrings._strings(length)(batch)]
    assert max(map(len, made)) < 500 + 64 and len(made) > 5
    assert [(r["row"]["id"], r["piece"], r["start"], r["string"]) for part in made for r in part] == \
        [(n, 10 * n, at, xxhash.xxh3_128_digest(t[at:at + length])) for n, t in enumerate(texts) for at in range(len(t) - length + 1)]


def test_refined_anchors_take_few_stored_steps(sc, prose, monkeypatch):
    # Every stored step costs files and task records in proportion to the partitions: quarters take half as many as halves.
    made, stored = " ".join(prose(12, 21)), []
    docs = sc.createDataFrame([(k, made[:200 + 5 * k] + f"<{k}>" + made[200 + 5 * k:]) for k in range(40)], "doc_id bigint, text string")
    monkeypatch.setattr(substrings, "BATCH_BYTES", 300)
    monkeypatch.setattr(substrings, "cut", lambda df: stored.append(1) or cut(df))
    got = rows(substrings.remove(docs, length=256), "doc_id", "n_removed")
    data = [t.encode() for _, t in texts(docs)]
    want = [(doc, int(gone.sum())) for (doc, _), gone in zip(texts(docs), brute_spans(data, 256), strict=True)]
    assert got == sorted(want, key=repr) and sum(n for _, n in got) > 0
    assert 10 <= len(stored) <= 14  # 6, and 2 for each of at most 4 rounds


def test_interval_expansion():
    rng = random.Random(5)
    for turn in range(150):
        length = rng.choice([4, 8, 20])
        data = [bytes(rng.choice(b"ab" if turn % 2 else b"abcdefgh") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 6))]
        data.append(data[0][5:] + b"x" + data[0])
        seen = collections.Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
        for d, found in zip(data, substrings.repeated_strings(data, length), strict=True):
            assert found.tolist() == [seen[d[i:i + length]] > 1 and i + length <= len(d) for i in range(len(d))]


# 4

def test_warc_round_trip(sc, tmp_path):
    rng = random.Random(1)
    big = "".join(rng.choice("abc é\r\n") for _ in range(5000)) + "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"
    pages = [(1, "http://a/\r\nX: y", "<p>"), (2, None, None), (3, "u", ""), (4, "u", big), (5, "u", big), (6, "u", "WARC/1.1\r\n"), (7, "u", "x\r\n"),
             (8, "u", "same"), (8, "u", "same"), (9, "u", "\r\n\r\n"), (None, "u", "<p>"), (None, "u", "null page")]
    frame = sc.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("record", F.lit("z")).withColumn("sha1", F.lit(1))
    for name, least in (("all", 0), ("long", 100)):
        warc.write(frame, f"{tmp_path}/{name}", chunk=1000, least=least)
        table = warc.read_chunks(sc, f"{tmp_path}/{name}")
        top = {}
        for page, _, html in pages:
            top[html or ""] = max(top.get(html or "", -1), -1 if page is None else page)
        want = []
        for page, _, html in pages:
            data = (html or "").encode()
            first = len(data) < least or page == top[html or ""] or top[html or ""] == -1
            want.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first else "revisit",
                         None if first else top[html or ""]))
        assert rows(warc.records(table), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
        stored = collections.defaultdict(list)
        for r in table.where("type <> 'revisit'").collect():
            stored[r["record"]].append((r["number"], r["data"]))
        payloads = sorted(b"".join(bytes(d) for _, d in sorted(x)) for x in stored.values())
        assert payloads == sorted((h or "").encode() for (_, _, h), w in zip(pages, want, strict=True) if w[3] == "response")
        assert max(len(r["data"]) for r in table.collect()) <= 1000
    broken = table.withColumn("so_far", F.when(F.col("number") == 2, "x").otherwise(F.col("so_far")))
    with pytest.raises(Exception, match="does not have its digest"):
        warc.records(broken).count()
    warc.write(frame.where("1 = 0"), f"{tmp_path}/none")
    assert warc.records(warc.read_chunks(sc, f"{tmp_path}/none")).count() == 0


# 5

def test_encoder_is_the_tokenizer():
    coder, plain, rng = packing.Encoder(WORD_BPE), Tokenizer.from_file(WORD_BPE), random.Random(1)
    letters = [*"abIXÀéßſşİıΣς'.,!?<|>09²½ªﬁ中\xad_-$\x1d\x85\xa0́‍﻿", " ", "\n", "<|endoftext|>", "'ll", "'RE", "Straße", "<|x"]
    for _ in range(5000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(12)))
        assert np.frombuffer(coder.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_and_their_marks_are_not_searched_for_parts(monkeypatch):
    coder, plain, rng = packing.Encoder(WORD_BPE), Tokenizer.from_file(WORD_BPE), random.Random(2)

    class Unused:
        def findall(self, word):
            raise AssertionError(word)

    monkeypatch.setattr(coder, "pattern", Unused())
    letters = [c for n in range(0x180) if (c := chr(n)).isalpha() and n != 0x130]
    marks = [chr(n) for n in range(33, 127) if not chr(n).isalnum()]
    words = [*letters, *("a" + m for m in marks), "don''", "THONSH!!", "X'", "\u00aa\u00ba\u00b5.$$$"]
    words += ["".join(rng.choices(letters, k=rng.randrange(1, 9))) + "".join(rng.choices(marks, k=rng.randrange(4))) for _ in range(3000)]
    for word in words:
        assert np.frombuffer(coder.ids(word), "<u4").tolist() == plain.encode(word, add_special_tokens=False).ids, repr(word)
    with pytest.raises(AssertionError):  # what follows an apostrophe has rules of its own
        coder.ids("don't")


def test_packing(awkward, none, sc, prose):
    s = prose(300, 8)
    more = sc.createDataFrame([(1000 + k, " ".join(s[k % 300:k % 300 + k % 7])) for k in range(900)], "doc_id bigint, text string")
    docs = awkward.unionByName(more, allowMissingColumns=True)
    cut_up = packing.pieces(docs, WORD_BPE, capacity=256)
    plain, want = Tokenizer.from_file(WORD_BPE), []
    for doc, text in texts(docs):
        ids = np.array(plain.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(doc, k // 256, k, len(ids[k:k + 256]), zlib.crc32(ids[k:k + 256].tobytes())) for k in range(0, len(ids), 256)]
    packed = packing.pack(cut_up, capacity=256, shard=100).collect()
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[c] for c in names) for r in packed), key=repr) == sorted(want, key=repr)
    sequences = collections.defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1].tolist()] and sum(n for _, n in places) <= 256
    assert len(sequences) <= 1.01 * math.ceil(sum(r["length"] for r in packed) / 256) + 1
    assert packing.pack(packing.pieces(none, WORD_BPE)).count() == 0


def test_crossover_keeps_every_piece_once():
    rng = random.Random(2)
    sizes = [rng.randint(1, 99) for _ in range(200)]
    one = packing.grouping(sizes, sorted(range(200), key=lambda i: -sizes[i]), [], 100)
    two = packing.grouping(sizes, list(range(200)), [], 100)
    for _ in range(20):
        child = packing.crossover(sizes, one, two, 100, rng)
        assert sorted(i for g in child for i in g) == list(range(200)) and max(sum(sizes[i] for i in g) for g in child) <= 100
        one, two = child, one
    best = packing.evolve(sizes, [], 100, 1)[0]
    assert len(best) <= len(packing.grouping(sizes, sorted(range(200), key=lambda i: -sizes[i]), [], 100))


# 6

def brute_sentences(docs, words):
    """Sentences that go: of every span of whole sentences with the words, each occurrence but the first."""
    ends, closers = ".!?\n\u0589\u061f\u06d4\u0964\u0965\u1362\u203c\u2047\u2048\u2049\u3002\ufe52\uff01\uff0e\uff1f\uff61", "\"')]\u00bb\u2019\u201d\u300d\u300f"
    places = {}
    split = []
    for row, (doc, text) in enumerate(docs):
        parts, part, state = [], "", 0  # 0 in words, 1 in marks, 2 in closers, 3 in blanks
        for c in text or "":
            now = 1 if c in ends and state < 2 else 2 if c in closers and 0 < state < 3 else 3 if c in " \t\n\v\f\r\u3000" and state else 0
            if state and not now:
                parts, part = [*parts, part], ""
            part, state = part + c, now or (1 if c in ends else 0)
        parts += [part] if part else []
        assert "".join(parts) == (text or "")
        flat = [" ".join(re.sub(r"[ \t-\r]+", " ", x.lower()).split(" ")).strip(" ") for x in parts]
        n = [sum(len(re.findall("[\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]|[^\u0e00-\u0eff\u3040-\u30ff\u3400-\u9fff]+", w)) for w in x.split(" ") if w) for x in flat]
        split.append((parts, n))
        for a in range(len(parts)):
            for b in range(a, len(parts)):
                if sum(n[a:b + 1]) >= words:
                    places.setdefault(tuple(flat[a:b + 1]), []).append((row, a, b))
    gone = [set() for _ in docs]
    for found in places.values():
        for row, a, b in sorted(found)[1:]:
            # A longer span is one of its shortest ones and more of the same: all that it covers counts only with the words of its own.
            gone[row] |= set(range(a, b + 1))
    return [(doc, len(parts), len(out), None if text is None else "".join(x for k, x in enumerate(parts) if k not in out))
            for (doc, text), (parts, _), out in zip(docs, split, gone, strict=True)]


def test_sentences(awkward, none):
    docs = awkward.where("doc_id is not null and doc_id <> 7").dropDuplicates(["doc_id"])
    want = brute_sentences(sorted(texts(docs)), sentences.WORDS)
    assert rows(sentences.remove(docs), "doc_id", "n_sentences", "n_removed", "kept_text") == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 60
    assert sentences.remove(awkward).count() == awkward.count() and sentences.remove(none).count() == 0


# 7

def brute_components(docs, percent, size=5):
    sets = {}
    for doc, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
        sets[doc] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
    label = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {d: low if x == high else x for d, x in label.items()}
    return sorted((d, len(sets[d]), label[d], label[d] == d) for d in sets)


@pytest.mark.parametrize("group_bytes", [8 << 20, 2000])
def test_minhash(sc, awkward, none, prose, group_bytes):
    s, rng = prose(200, 6), random.Random(6)
    base = " ".join(s[:25]).split()
    made = []
    for k in range(60):  # around the threshold, chained by common ancestors
        words = list(base if k % 3 else made[-1][1].split() if made else base)
        for _ in range(rng.randrange(1, 8)):
            words[rng.randrange(len(words))] = f"w{k}"
        made.append((300 + k, " ".join(words)))
    docs = awkward.where("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(
        sc.createDataFrame(made, "doc_id bigint, text string"), allowMissingColumns=True)
    got = minhash.near_duplicates(docs, percent=85, group_bytes=group_bytes)
    assert rows(got, "doc_id", "n_shingles", "component_id", "kept") == sorted(brute_components(texts(docs), 85), key=repr)
    if group_bytes > 2000:
        found = {r["doc_id"]: r for r in minhash.near_duplicates(awkward, percent=85).where("component_id = 5").collect()}
        assert set(found) == {5, 6, 10, None} and not found[None]["kept"]
        kept = minhash.clean(awkward, percent=80)
        assert kept.columns == awkward.columns and rows(kept.where("doc_id in (5, 6, 10)"), "doc_id") == [(5,)]
        assert minhash.near_duplicates(none).count() == 0


def test_components(sc):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = rows(components.components(sc.createDataFrame(edges, "a bigint, b bigint")), "node", "component")
    assert got == sorted([(k, 0) for k in range(41)] + [(k, 100) for k in range(100, 160)] + [(200, 200), (201, 200)], key=repr)


def test_confirmed_links_come_as_stars(sc, prose, monkeypatch):
    # A chain of near copies in one task: its component is there after one round, and another would bring nothing.
    words, made, stored = " ".join(prose(30, 8)).split(), [], []
    for k in range(30):
        words = [*words[:5 * k], f"new{k}", *words[5 * k + 1:]]
        made.append((1000 - k, " ".join(words)))
    docs = sc.createDataFrame(made, "doc_id bigint, text string")
    once = components.components

    def counted(edges):
        stored.append(0)
        return once(edges)

    def step(df):
        stored[-1] += 1
        return cut(df)

    monkeypatch.setattr(minhash, "components", counted)
    monkeypatch.setattr(components, "cut", step)
    got = rows(minhash.near_duplicates(docs, percent=85), "doc_id", "component_id")
    assert got == sorted(((d, c) for d, _, c, _ in brute_components(made, 85)), key=repr) and {c for _, c in got} == {971}
    assert len(stored) == 2 and stored[1] == 2


# 8

def test_language(sc, awkward, none, small):
    docs = sc.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/documents.parquet")
    held = "pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0"
    model = language.fit(docs.where(f"not ({held})"))
    assert sorted(model) == ["de", "en", "es", "fr"] and max(map(len, model.values())) <= language.DICTIONARY_BYTES
    found = language.predict(docs.where(held), model)
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.95 and n > 150
    assert found.where("rejected").count() < 0.05 * n
    got = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in language.predict(awkward, model).collect()}
    assert got[1] == got[2] == got[3] == got[4] == (language.UNKNOWN, 0.0, True) and got[12][0] != language.UNKNOWN
    assert language.predict(awkward, model).columns == [c for c in awkward.columns if c != "score"] + ["lang_pred", "score", "rejected"]
    assert language.fit(none) == {} and {r["lang_pred"] for r in language.predict(awkward, {}).collect()} == {language.UNKNOWN}
    assert language.predict(none, model).count() == 0


def brute_language(rows, docs):
    """{row number: (language, score)} by one compressor for each language, made anew for every block; ``rows`` are (place, text, lang)."""
    pieces = collections.defaultdict(list)
    for place, text, lang in rows:
        if text is not None and lang is not None:
            at = place % max(1, len(text) - 799)
            pieces[lang].append((place, text[at:at + 800]))
    plain = lambda t: re.sub(r"[\W\d_]+", " ", t.lower()).encode()
    known = {lang: plain(" ".join(x for _, x in sorted(own)[:400]))[:1 << 16] for lang, own in sorted(pieces.items())}
    settings = zstandard.ZstdCompressionParameters.from_level(5, min_match=3, write_content_size=False, write_dict_id=False)

    def size(content, data):
        one = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        one.precompute_compress(compression_params=settings)
        packer = zstandard.ZstdCompressor(dict_data=one, compression_params=settings)
        return sum(len(packer.compress(data[i:i + 4096])) for i in range(0, len(data), 4096))

    out = []
    for text in docs:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        (best, lang), (second, _) = sorted((size(content, plain(text)), lang) for lang, content in known.items())[:2]
        out.append((lang, min(1.0, 4 * (1 - best / second))))
    return out


def test_every_prediction_of_the_query(sc, small, tmp_path):
    """Predictions equal brute force, and nothing held out reaches them: neither labels nor sources."""
    table = sc.read.parquet(f"{small}/documents.parquet")
    held = lambda doc: zlib.crc32(str(doc).encode()) % 5 == 0
    given = table.select("doc_id", "text", "lang", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).alias("place")).collect()
    want = brute_language([(r["place"], r["text"], r["lang"]) for r in given if not held(r["doc_id"])], [r["text"] for r in given])
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in QUERIES["op8_language"](sc, small).collect()}
    assert got == {r["doc_id"]: (held(r["doc_id"]), *x) for r, x in zip(given, want, strict=True)}
    poisoned = table.withColumns({"lang": F.when(F.expr("pmod(crc32(cast(cast(doc_id as string) as binary)), 5) = 0"), "xx").otherwise(F.col("lang")),
                                  "source": F.lit("fr")})
    poisoned.write.parquet(f"{tmp_path}/documents.parquet")
    assert got == {r["doc_id"]: (r["held_out"], r["lang_pred"], r["score"]) for r in QUERIES["op8_language"](sc, str(tmp_path)).collect()}


def test_frequent_languages_are_thinned_before_they_are_ranked(sc):
    """A sample of more rows than it needs is the same as that of all rows; texts longer than a piece give different places of theirs."""
    many = sc.range(3000).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 300), k -> concat('w', id * k % 997, 'xyz'))) as text",
                                     "if(id % 10 = 0, 'aa', 'bb') as lang") \
        .withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2))
    model = language.fit(many)
    for lang in ("aa", "bb"):
        rows_of = sorted((r["place"], r["text"]) for r in many.where(F.col("lang") == lang).collect())[:400]
        pieces = [t[place % max(1, len(t) - 799):][:800] for place, t in rows_of]
        assert model[lang] == language.letters(" ".join(pieces))[:language.DICTIONARY_BYTES]


# 9

def test_licenses(sc, awkward, none):
    long = next(t for n, t in licenses.KNOWN if n == "ISC")
    docs = sc.createDataFrame([
        (1, "Copyright (c) 2020 Some One\n\n" + long.upper().replace("“", '"').replace(",", " ,").replace("\n", "\n  ")), (2, long + " But not for me."),
        (3, "licensed under the apache LICENCE, version 2.0\nOther line\n * Released under the MIT License.\n"), (4, None), (5, "© 2020"),
        (6, "All rights reserved.\nReleased under the MIT Licence")], "doc_id bigint, text string")
    known = licenses.known_digests(sc)
    assert rows(licenses.scan(docs, known), "doc_id", "license", "n_notices", "licenses") == [
        (1, "ISC", 0, "ISC"), (2, None, 0, ""), (3, None, 2, "Apache-2.0,MIT"), (4, None, 0, ""), (5, None, 0, ""), (6, "MIT", 1, "MIT")]
    assert rows(licenses.scan(awkward, known).where("license is not null"), "doc_id", "license") == [(16, "CC-BY-NC-4.0")]
    assert licenses.scan(awkward, known).count() == awkward.count() and licenses.scan(none, known).count() == 0


# 10

def brute_fingerprints(docs):
    parts = lambda t: set(re.findall(rf"[^\n]{{{paragraph_sketch.PARAGRAPH}}}[^\n.!?]*[.!?]+|[^\n]+", t))
    docs = sorted(((d, t or "") for d, t in docs), key=lambda x: (x[0] is None, -(x[0] or 0)))
    near = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    out = []
    for n, (doc, text) in enumerate(docs):
        follows, half = docs[(n + 1) % len(docs)][1], len(text) // 2
        edited = text[:len(text) - half] + follows[:half]
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), near(parts(text), parts(edited)), near(parts(text), parts(follows))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order_rows", [2000, 3])
def test_fingerprints(awkward, none, prose, sc, monkeypatch, order_rows):
    monkeypatch.setattr(paragraph_sketch, "ORDER_ROWS", order_rows)
    docs = awkward.where("doc_id is not null or text is null").dropDuplicates(["doc_id"])
    got = paragraph_sketch.fingerprints(docs)
    assert rows(got, "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next") == brute_fingerprints(texts(docs))
    prints = {r["doc_id"]: r["fingerprint"] for r in got.collect()}
    assert prints[5] == prints[6] != prints[10]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
    assert paragraph_sketch.fingerprints(awkward).count() == awkward.count() and paragraph_sketch.fingerprints(none).count() == 0


def test_peeling_gives_back_the_difference(sc):
    rng = random.Random(3)
    many = [([rng.randrange(1 << 60) for _ in range(n)], [rng.randrange(1 << 60) for _ in range(m)], [rng.randrange(1 << 60) for _ in range(9)])
            for n, m in ((0, 0), (1, 0), (3, 4), (0, 6), (9, 9), (60, 50))]
    frame = sc.createDataFrame([(a + c, b + c, a + b) for a, b, c in many], "one array<bigint>, two array<bigint>, want array<bigint>")
    base = paragraph_sketch.peeled(paragraph_sketch.minus(paragraph_sketch.sketch("one"), paragraph_sketch.sketch("two")))
    for r in frame.selectExpr("want", f"{base} as small", f"{paragraph_sketch.difference('one', 'two')} as found").collect():
        assert sorted(r["found"]) == sorted(r["want"])
        assert r["small"] is None and len(r["want"]) > 9 or sorted(r["small"]) == sorted(r["want"])


def test_licenses_find_words_once(sc):
    """Whole texts and their lines share one search for words; spellings meet line breaks in whole texts only."""
    docs = sc.createDataFrame([(1, "Licensed under the Apache Licence,\r\nVersion 2.0."), (2, "Copyright 2001 Foo\nReleased — under\nthe MIT  licence"), (3, "per\ncent"),
                               (4, "percent"), (5, "Licensed under CC0\n1.0.\n\n Licensed under CC0 1.0"), (6, "...\n"), (7, None)], "doc_id bigint, text string")
    known = licenses.known_digests(sc)
    found = licenses.scan(docs, sc.createDataFrame(known.collect(), known.schema))
    got = {r["doc_id"]: r for r in found.collect()}
    assert {d: (r["license"], r["n_notices"], r["licenses"]) for d, r in got.items()} == {
        1: ("Apache-2.0", 0, "Apache-2.0"), 2: ("MIT", 0, "MIT"), 3: (None, 0, ""), 4: (None, 0, ""), 5: (None, 1, "CC0-1.0"), 6: (None, 0, ""), 7: (None, 0, "")}
    assert got[3]["digest"] == got[4]["digest"] == hashlib.sha256(b"percent").hexdigest() and got[6]["digest"] is got[7]["digest"] is None
    # Once for texts and lines, once for texts with a title, once for paragraphs.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("lower(") == 3


def test_licenses_in_their_usual_files(sc):
    body, isc = (next(t for n, t in licenses.KNOWN if n == x and "\n" in t) for x in ("MIT", "ISC"))
    wrapped = "ISC License\n\nCopyright (c) 2020, Some One\n\n" + isc.replace("above copyright notice", "above\ncopyright notice")
    full = {n: t for n, t in licenses.known_texts()}
    bullets = full["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ")
    docs = [
        (1, "MIT License\n\nCopyright (c) 2020 Some One\n\n" + body, "MIT", "MIT"),
        (2, "The MIT License (MIT)\r\n\r\nCopyright © Some One <a@b.c>\r\nAll rights reserved.\r\n\r\n" + body.replace("\n", "\r\n"), "MIT", "MIT"),
        (3, wrapped, "ISC", "ISC"),
        (4, wrapped.replace("copyright notice and", "notice and"), None, ""),
        (5, "Copyright The Project Authors\n" + full["GPL-3.0"], "GPL-3.0", "GPL-3.0"),
        (6, full["Apache-2.0"], "Apache-2.0", "Apache-2.0"),
        (7, "# BSD 3-Clause License\n\n" + bullets, "BSD-3-Clause", "BSD-3-Clause"),
        (8, "A tool for text.\n\n## License\n\nCopyright 2021 Some One\n\n" + body + "\n\nThanks for reading.\n", None, "MIT"),
        (9, "A tool for text.\n\n" + body.split("\n\n")[0] + "\n\nThanks.\n\n" + "\n\n".join(body.split("\n\n")[1:]), None, ""),
        (10, "Read this.\n\nReleased under\nthe MIT License.\n\nEnd.", None, "MIT"),
        (11, "MIT License", None, ""),
    ]
    for n, name in enumerate(("CC0-1.0", "MPL-2.0", "GPL-2.0", "LGPL-2.1", "BSD-2-Clause")):
        text = next(t for x, t in licenses.known_texts() if x == name and len(t) > 1000)
        docs.append((20 + n, text.upper().replace("\n", "\n  "), name, name))
    frame = sc.createDataFrame([x[:2] for x in docs], "doc_id bigint, text string")
    got = licenses.scan(frame, licenses.known_digests(sc))
    assert {r["doc_id"]: (r["license"], r["licenses"]) for r in got.collect()} == {d: (one, many) for d, _, one, many in docs}
    assert got.where("digest is null").count() == 0


def test_passages(sc, prose):
    s = prose(60, 41)
    one, more = " ".join(x.rstrip(".") for x in s[:8]), s[8:14]
    inner = f"the end of this sentence. {one}. and the start of that one"       # one whole sentence, pasted between two half ones
    assert 60 <= len(inner.split()) and len(one.split()) >= sentences.WORDS
    short, han = " ".join("ABCDEFGHIJKLMNOPQRST"[k] + "." for k in range(20)), "今天天气很好我们去公园散步。他们在湖边看见了许多白色的鸟。"
    docs = [(1, f"First {inner} goes on. {s[20]}"), (2, f"{s[21]} Other words before {inner} and so on. {s[22]}"),
            (3, f"{s[23]} {short} {s[24]}"), (4, f"{s[25]} {short} {s[26]}"), (5, "我昨天写信。" + han + "明天再说。"), (6, "这是别的事情。" + han),
            (7, " ".join(more)), (8, f"{s[27]} {' '.join(more)} {s[28]}"), (9, "\n" + s[29] + s[30]), (10, None), (11, f"{s[31]} {more[0]} {more[1]}")]
    frame = sc.createDataFrame(docs, "doc_id bigint, text string").withColumn("row", F.lit("z"))
    got = {r["doc_id"]: r for r in sentences.remove(frame, words=12).collect()}
    assert sorted((d, r["n_sentences"], r["n_removed"], r["kept_text"]) for d, r in got.items()) == brute_sentences(docs, 12)
    left = {d: r["kept_text"] for d, r in got.items()}
    for d, t in docs:
        if d in (1, 3, 5, 7, 9, 10):
            assert (left[d], got[d]["n_removed"]) == (t, 0)
    assert one not in left[2] and left[2].startswith(s[21]) and left[2].endswith(s[22]) and got[2]["n_removed"] == 1
    assert left[4] == f"{s[25]} {s[26]}" and got[4]["n_removed"] == 20
    assert left[6] == "这是别的事情。"
    assert left[8] == f"{s[27]} {s[28]}" and left[11] == s[31] + " "
    # The shortest spans cover every repeated span that has the words.
    rng = random.Random(5)
    many = []
    for n in range(120):
        run = [rng.choice(("a b c. ", "b!", "... ", "a a\n", "c b?) ", "A  B\tC d. ", "e f g h i j. ")) for k in range(rng.randrange(1, 9))]
        many.append((n, "".join(f"{n}{k} {n}. " for k in range(rng.randrange(4))) + "".join(run) + f"{n} end"))
    got = sentences.remove(sc.createDataFrame(many, "doc_id bigint, text string"), words=5)
    want = brute_sentences(many, 5)
    assert rows(got, "doc_id", "n_sentences", "n_removed", "kept_text") == sorted(want, key=repr) and sum(x[2] for x in want) > 100
