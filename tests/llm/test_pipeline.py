"""The pipeline against a plain chain of its stages' rules."""

import random
import shutil
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from snapstats.llm import language, minhash, packing
from snapstats.llm.common import map_rows
from test_llm_operators import brute_components, brute_copies, brute_hits


@pytest.fixture(scope="module")
def folder(sc, prose, tmp_path_factory):
    s, rng = prose(500, 21), random.Random(7)
    out = str(tmp_path_factory.mktemp("tables"))
    german = ["".join(rng.choice("äöüßkzwgmchb") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    rows = [(k, " ".join(s[5 * k:5 * k + 20]), "en", f"s{k}") for k in range(80)]
    rows += [(100 + k, " ".join(rng.choice(german) for _ in range(80)), "de", "g") for k in range(30)]
    rows += [(200, " ".join(s[:20]), "en", "copy"), (201, " ".join(s[:20]) + " one more end", "en", "near"), (202, None, None, "null"), (203, "", "en", "empty"),
             (204, "12 34 !!", "en", "no letters"), (205, " ".join(s[300:304]) + " " + " ".join(s[10:20]), None, "hit"),
             (206, "é" * 900 + " ".join(s[320:330]), "en", "cut"), (207, "é" * 900 + "z" + " ".join(s[330:340]), "en", "cut")]
    sc.createDataFrame([(d, t, x, src, len(t or "")) for d, t, x, src in rows],
                       "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{out}/documents.parquet")
    sc.createDataFrame([(1, " ".join(s[300:304])), (2, " ".join(s[499:500] * 3))], "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_pipeline(sc, folder):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["known_language", "near_unique", "without_repeats", "decontaminated", "packed"]
    table = sc.read.parquet(f"{folder}/documents.parquet")
    model = language.fit(table)
    compressors = language._compressors(model)
    docs = [(r["doc_id"], r["text"]) for r in table.collect()]
    docs = [(d, t) for d, t in docs if (x := language.classify(model, compressors, t))[0] != "und" and x[1] >= 4 * language.MARGIN]
    assert not {202, 203, 204} & {d for d, _ in docs} and len(docs) > 100
    kept = {d for d, _, _, is_kept in brute_components(docs, 80) if is_kept}
    assert not {200, 201} & kept
    docs = sorted((d, t) for d, t in docs if d in kept)
    data = [t.encode() for _, t in docs]
    docs = [(d, bytes(np.frombuffer(x, np.uint8)[~gone]).decode(errors="ignore"))
            for (d, _), x, gone in zip(docs, data, brute_copies(data, corpus_pipeline.REPEATED_BYTES), strict=True)]
    items = [(r["item_id"], r["text"]) for r in sc.read.parquet(f"{folder}/benchmark.parquet").collect()]
    bad = {x[0] for x in brute_hits(docs, items, 13) if x[-1]}
    assert 205 in bad
    plain, want = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), []
    for doc, text in docs:
        if doc not in bad:
            ids = np.array(plain.encode(text, add_special_tokens=False).ids + [0], "<u4")
            want += [(doc, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes())) for k in range(0, len(ids), 2048)]
    got = corpus_pipeline.run(sc, folder).collect()
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in names) for r in got) == sorted(want)


def test_a_repeated_passage_stays_once(sc, prose):
    """A passage in three documents is whole in the first one afterwards, and in no other; the rest of the texts stays."""
    s = prose(200, 51)
    passage = " ".join(s[:6])
    assert len(passage.encode()) >= corpus_pipeline.REPEATED_BYTES and len(passage.split()) > 50
    docs = [(n, f"{' '.join(s[20 * n:20 * n + 8])} half a sentence {passage} and on {' '.join(s[20 * n + 8:20 * n + 16])}") for n in (3, 1, 2)] + [(4, None), (5, "")]
    frame = sc.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["without_repeats"](sc, frame, "").collect()}
    before = dict(docs)
    assert left[1] == before[1] and left[4] is None and left[5] == ""
    for d in (2, 3):
        assert len(left[d]) < len(before[d]) - len(passage) + 30 and not any(x in left[d] for x in s[1:5])
        assert left[d].startswith(before[d][:20]) and left[d].endswith(before[d][-20:])


def test_a_passage_between_like_words_stays_once(sc, prose):
    """Copies that have the same blanks around them, unlike the first place, go as well: their edges are strings of their own."""
    s = prose(200, 52)
    passage = " ".join(s[:8])
    assert len(passage.encode()) >= corpus_pipeline.REPEATED_BYTES
    docs = [(1, f"{s[20]}\n{passage}\n{s[21]}")] + [(n, f"{s[20 * n]} {passage} {s[20 * n + 1]}") for n in (2, 3, 4)] + [(5, "x" * 900)]
    frame = sc.createDataFrame([(d, t, "en", "s", len(t)) for d, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    left = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["without_repeats"](sc, frame, "").collect()}
    assert left[1] == dict(docs)[1] and left[5] == "x" * corpus_pipeline.REPEATED_BYTES
    for d in (2, 3, 4):
        assert not any(x in left[d] for x in s[:8]) and left[d].startswith(s[20 * d][:-1]) and left[d].endswith(s[20 * d + 1][1:])


def test_stages_return_the_columns_of_documents(sc, folder):
    docs = sc.read.parquet(f"{folder}/documents.parquet")
    for frame in (docs, docs.where("1 = 0")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(sc, frame, folder)
            assert out.dtypes == docs.dtypes
        assert corpus_pipeline.STAGES[-1][1](sc, frame, folder).columns[:3] == ["doc_id", "piece", "start"]
    left = corpus_pipeline.STAGES[2][1](sc, docs, folder).collect()
    assert all(r["n_chars"] is None if r["text"] is None else r["n_chars"] == len(r["text"]) for r in left)


def test_pipeline_with_repeated_rows_and_null_ids(sc, prose, tmp_path):
    """Of every group one row, whole, whether ids are repeated, shared by different texts, or missing."""
    s, rng = prose(500, 31), random.Random(8)
    german = ["".join(rng.choice("äöüßkzwgmchb") for _ in range(rng.randint(3, 9))) for _ in range(200)]
    body = lambda k: " ".join(s[10 * k:10 * k + 10])
    docs = [(k, body(k), "en") for k in range(20)]
    docs += [(3, body(3), "en"), (3, body(3), "en"), (4, body(30), "en")]                # repeated rows; one id with another text
    docs += [(None, body(21), "en"), (None, body(21), "en"), (None, body(22), "en")]      # without id, equal texts
    docs += [(None, body(22) + " one more end", "en"), (None, body(5), "en")]             # without id, near copies
    docs += [(4, body(7), "en"), (900, body(7) + " one more end", "en")]                  # another text of 4 is the smallest of its group
    docs += [(100 + k, " ".join(rng.choice(german) for _ in range(80)), "de") for k in range(20)]
    frame = sc.createDataFrame([(d, t, x, f"s{n}", len(t)) for n, (d, t, x) in enumerate(docs)],
                               "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    sc.createDataFrame([(1, "none of these words")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert all(len(t.encode()) >= 400 for _, t, _ in docs)
    model = language.fit(frame)
    compressors = language._compressors(model)
    known = [(d, t) for d, t, _ in docs if (x := language.classify(model, compressors, t))[0] != "und" and x[1] >= 4 * language.MARGIN]
    assert len(known) == len(docs)
    order = sorted(known, key=lambda x: (x[0] is None, x[0] or 0, len(x[1])))
    kept = {n for n, _, _, is_kept in brute_components([(n, t) for n, (_, t) in enumerate(order)], 80) if is_kept}
    rows = lambda out: sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)
    near = corpus_pipeline.STAGES[1][1](sc, frame, str(tmp_path))
    # Of near copies of one id, or without one, either may stay.
    plain = lambda found: sorted(((d, t.removesuffix(" one more end")) for d, t in found), key=repr)
    want = [order[n] for n in sorted(kept)]
    assert plain(rows(near)) == plain(want) and len(want) == 20 + 1 + 2 + 20
    sources = [r["source"] for r in near.collect()]
    assert len(set(sources)) == len(sources)
    encoder, packed = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), corpus_pipeline.run(sc, str(tmp_path)).collect()
    sizes = lambda found: sorted(len(encoder.encode(t, add_special_tokens=False).ids) + 1 for _, t in found)
    either = len(encoder.encode(" one more end", add_special_tokens=False).ids)
    lengths = sorted(r["length"] for r in packed)
    assert len(lengths) == len(want) and sum(lengths) in (sum(sizes(want)), sum(sizes(want)) + either)


def test_workers_forget_the_words_of_packed(sc, folder, tmp_path, monkeypatch):
    """Python workers stay for later stages, so what they remembered would be memory taken from those."""
    def words(path):
        def make():
            return lambda batch: {"n": [len(packing._encoders[path].words) if path in packing._encoders else 0] * batch.num_rows}

        return sum(r["n"] for r in map_rows(sc.range(64).repartition(16), "n bigint", make).collect())

    docs = sc.read.parquet(f"{folder}/documents.parquet")
    names = [shutil.copy(public_tokenizers.path(corpus_pipeline.TOKENIZER), f"{tmp_path}/{n}.json") for n in range(2)]
    plain = packing.pieces(docs, names[0]).collect()
    assert words(names[0]) > 0  # workers are used again
    monkeypatch.setattr(public_tokenizers, "path", lambda name: names[1])
    got = dict(corpus_pipeline.STAGES)["packed"](sc, docs, folder).collect()
    assert words(names[1]) == 0
    columns = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in columns) for r in got) == sorted(tuple(r[c] for c in columns) for r in plain)


def test_numbered_rows_are_stored_small(sc, folder):
    """They are on disk as long as the next stage reads the result, so they count beside its own files."""
    top = Path(sc.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = {*top.glob("rows-*")}
    docs = sc.read.parquet(f"{folder}/documents.parquet")
    assert minhash.clean(docs).count() > 0
    (stored,) = {*top.glob("rows-*")} - before
    files = [pq.ParquetFile(f).metadata for f in stored.glob("*.parquet")]
    assert sum(m.num_rows for m in files) == docs.count()
    assert {m.row_group(0).column(1).compression for m in files if m.num_row_groups} == {"ZSTD"}
