"""Vectors, archives, licenses, merge-dropout and the pipeline against brute force and round trips."""

from __future__ import annotations

import hashlib
import io
import itertools
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import dropout_bpe, licenses, nearest, vector_dedup, vectors, warc
from sluice.llm.queries import ORACLES, QUERIES
from sluice.session import scratch_path

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
VECTORS = "vec_id long, embedding array<float>, bucket int, head string, table int"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash", 2) for i, v in rows], VECTORS)


def some_vectors():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(12, 16)).astype(np.float32)
    rows = [(i, base[i % 12].tolist() if i % 5 == 0 else (base[i % 12] + rng.normal(scale=0.05 * (i % 7), size=16)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(500, (2 * base[3]).tolist()), (501, None), (502, [0.0] * 16), (503, [math.nan] + [1.0] * 15), (504, [math.inf] * 16), (505, [None] + [1.0] * 15)]
    rows += [(None, base[0].tolist()), (506, [1.0, 2.0]), (507, [1.0, 2.0]), (50, base[2].tolist()), (508, []), (509, (1e30 * base[4].astype(float)).tolist())]
    return rows


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, np.float64), np.array(b, np.float64)
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def test_nearest_against_brute_force(spark):
    rows = some_vectors()
    all_ = vector_frame(spark, rows)
    got = nearest.search(all_, all_.where("vec_id % 10 = 0"), k=5, block=16, probes=100_000, hashing=vectors.PStable(2, 3, 2.0)).collect()
    usable = {}
    for i, v in rows:
        if i is not None and good(v):
            usable[i] = min(usable.get(i, v), v)
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    for q in (i for i in usable if i % 10 == 0):
        scores = sorted(((-cosine(usable[q], v), i) for i, v in usable.items() if i != q and len(v) == len(usable[q])))[:5]
        assert [i for i, _ in found[q]] == [i for _, i in scores]
        assert np.allclose([s for _, s in found[q]], [-s for s, _ in scores], atol=1e-12)


@pytest.mark.parametrize("size, count", [(16, 8), (64, 30)])
def test_every_query_has_the_rows_it_is_owed(spark, size, count):
    """Small tables fill few buckets; what they do not give is found by comparing with all rows."""
    rng = np.random.default_rng(size)
    rows = [(i, rng.normal(size=size).tolist()) for i in range(count)] + [(900, [1.0, 2.0]), (901, [2.0, 1.0]), (902, None)]
    all_ = vector_frame(spark, rows)
    found = defaultdict(list)
    for r in sorted(nearest.search(all_, all_, block=7).collect(), key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append(r["vec_id"])
    sides = {i: np.array(v, np.float32).astype(float) for i, v in rows if v}
    for q, v in sides.items():
        others = sorted((-cosine(v, w), i) for i, w in sides.items() if i != q and len(w) == len(v))
        assert len(found[q]) == min(5, len(others))
        if len(others) <= 5 or len(v) == 16:
            assert set(found[q]) <= {i for _, i in others}
    assert found[900] == [901] and 902 not in found


def test_empty_tables_of_vectors_and_texts(spark):
    none = vector_frame(spark, [])
    some = vector_frame(spark, [(1, [1.0, 0.0]), (2, [1.0, 0.1])])
    assert nearest.search(none, none).count() == nearest.search(none, some).count() == nearest.search(some, none).count() == 0
    assert vector_dedup.near_duplicates(none).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string, ids int, own string")
    encoded = dropout_bpe.encode(docs, MODEL)
    assert encoded.count() == 0 and dropout_bpe.decode(encoded, MODEL).count() == 0


def test_columns_go_along_with_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "x"), (1, "a b", 2, "y"), (None, "c", 3, None), (None, None, 4, "z")], "doc_id long, text string, n int, own string")
    encoded = dropout_bpe.encode(docs, MODEL, carry=["n", "own"])
    assert encoded.columns == ["doc_id", "ids", "ids_crc32", "n", "own"]
    back = sorted((r["n"], r["doc_id"], r["text"], r["own"]) for r in dropout_bpe.decode(encoded, MODEL).collect())
    assert back == [(1, 1, "a b", "x"), (2, 1, "a b", "y"), (3, None, "c", None), (4, None, None, "z")]
    with pytest.raises(ValueError):
        dropout_bpe.encode(docs, MODEL, carry=["text"])


def test_the_merge_dropout_query_keeps_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "one two"), (None, "three"), (5, "four"), (5, "four"), (5, None), (6, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_merge_dropout"](spark, str(tmp_path)).collect()
    assert len(got) == 6 and all(r["lossless"] for r in got)
    assert sorted((r["doc_id"] or 0, r["n_tokens"] is None or r["n_tokens"] <= 0) for r in got).count((5, True)) == 1


def test_ids_that_spell_no_text_are_an_error(spark):
    encoder = dropout_bpe.MergeEncoder(MODEL)
    lone = encoder.bytes_[0xE9]
    with pytest.raises(Exception):
        encoder.decode_all(np.array([lone]), np.array([0, 1]))


def test_probes_come_in_the_order_of_success():
    f = np.array([0.1, 0.45, 0.8])
    cost = lambda s: sum(f[p] ** 2 if d < 0 else (1 - f[p]) ** 2 for p, d in s)
    sets = nearest.perturbations(f, 1000)
    assert sets[0] == [] and len(sets) == 27 and len({tuple(sorted(s)) for s in sets}) == 27
    assert [cost(s) for s in sets] == sorted(cost(s) for s in sets)


def test_the_likeliest_probes_are_those_of_all_sets():
    for f in np.random.default_rng(4).random((5, 8)):
        every = sorted(sum(c) for c in itertools.product(*((0, x * x, (1 - x) ** 2) for x in f)))
        sets = nearest.perturbations(f, 128)
        assert len({tuple(s) for s in sets}) == 128
        assert np.allclose([sum(f[p] ** 2 if d < 0 else (1 - f[p]) ** 2 for p, d in s) for s in sets], every[:128])


def test_rows_and_queries_of_a_search_are_dealt_out_once(spark, monkeypatch):
    """Not once per table or per bucket that a query visits."""
    rng, seen = np.random.default_rng(2), []
    all_ = vector_frame(spark, [(i, rng.normal(size=16).tolist()) for i in range(2000)])
    kind = type(all_)
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: seen.append(self.count()) or plain(self, *a, **b))
    assert nearest.search(all_, all_.where("vec_id % 50 = 0")).count() == 200
    assert max(seen) <= 2000 + 40 * spark.sparkContext.defaultParallelism


@pytest.mark.parametrize("hashing, probes", [(vectors.PStable(3, 4, 1.5), 6), (vectors.PStable(4, 8, 0.6), 20)])
def test_nearest_are_the_best_of_the_buckets_visited(spark, hashing, probes):
    """In wide buckets and in narrow ones, over several tasks; with groups of equal and of parallel vectors."""
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 6))
    m = (centres[rng.integers(0, 12, 600)] + 0.3 * rng.normal(size=(600, 6))).astype(np.float32)
    m[rng.random(600) < 0.1], m[rng.random(600) < 0.05] = m[0], m[0] * 2
    all_ = vector_frame(spark, [(i, v.tolist()) for i, v in enumerate(m)])
    got = defaultdict(list)
    found = nearest.search(all_, all_.where("vec_id % 3 = 0"), k=4, hashing=hashing, probes=probes, block=32, held=700).collect()
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append(r["vec_id"])
    places = hashing.places(vectors.unit(m.astype(float)))
    cells = np.floor(places)
    short = 0
    for q in range(0, 600, 3):
        near = set()
        for t in range(hashing.tables):
            for moves in nearest.perturbations(places[q, t] - cells[q, t], probes):
                cell = cells[q, t].copy()
                for p, step in moves:
                    cell[p] += step
                near |= set(np.flatnonzero((cells[:, t] == cell).all(axis=1)).tolist())
        near -= {q}
        short += len(near) < 4
        near = near if len(near) >= 4 else set(range(600)) - {q}
        assert got[q] == [i for _, i in sorted((-cosine(m[q], m[i]), i) for i in near)[:4]]
    assert short or hashing.projections == 4


def test_recall_on_the_whole_table(spark):
    rows = spark.read.parquet(f"{MEDIUM}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    found = defaultdict(set)
    for r in QUERIES["op2_nearest_neighbours"](spark, MEDIUM).collect():
        found[r["query_id"]].add(r["vec_id"])
    hit = total = 0
    for n in np.flatnonzero(ids % 50 == 0):
        s = u @ u[n]
        s[n] = -2
        best = {int(ids[i]) for i in np.argsort(-s)[:5]}
        hit, total = hit + len(best & found[int(ids[n])]), total + 5
    assert hit >= 0.9 * total


def brute_links(rows, least):
    n = len(rows)
    ok = [i is not None and good(v) for i, v in rows]
    links, parent = [0] * n, list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            same = ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]) and (rows[a][1] == rows[b][1] or cosine(rows[a][1], rows[b][1]) >= least)
            if same:
                links[a] += 1
                links[b] += 1
                parent[root(a)] = root(b)
    low = {}
    for a in range(n):
        if rows[a][0] is not None:
            low[root(a)] = min(low.get(root(a), rows[a][0]), rows[a][0])
    out = []
    for a, (i, _) in enumerate(rows):
        c = None if i is None else low[root(a)]
        out.append((i, links[a], c, None if i is None else i == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [8, 1024])
def test_vector_links_against_brute_force(spark, block):
    rows = [r for r in some_vectors() if r[0] != 50 or r[1] is None]
    got = vector_dedup.near_duplicates(vector_frame(spark, rows), block=block).collect()
    assert sorted(map(tuple, got), key=repr) == brute_links(rows, 0.95)


def test_vector_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op5_vector_dedup"](spark, SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == brute_links(rows, 0.95)


def test_larger_tables_get_more_tables_and_projections():
    small, large = vector_dedup.design(10_000, 0.95), vector_dedup.design(10**9, 0.95)
    assert large.projections > small.projections and large.tables > small.tables
    p = vectors.meeting(math.sqrt(0.1), vector_dedup.WIDTH)
    for d in (small, large):
        assert (1 - p**d.projections) ** d.tables <= vector_dedup.MISS


PAGES = [
    (1, "http://a/", "x" * 2000),
    (5, "http://b/\r\nEvil: 1", "x" * 2000),
    (3, None, "x" * 2000),
    (2, "http://c/", "é" * 499),
    (4, "http://c/", "é" * 499),
    (6, "u", None),
    (7, "u", ""),
    (8, "u", "line\r\n\r\nline\r\n" * 20_000),
    (9, "u", "line\r\n\r\nline\r\n" * 20_000),
    (None, "u", "x" * 2000),
    (10, "u", "é" * 500),
    (10, "u", "é" * 500),
]


def expected_pages():
    out = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        same = [j for j, _, g in PAGES if (g or "").encode() == data and j is not None]
        revisit = len(data) >= 1000 and i is not None and i != max(same)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", max(same) if revisit else None))
    return sorted(out, key=repr)


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*p, "clash", 0) for p in PAGES], "page_id long, url string, html string, payload string, chunk_no int")
    chunks = warc.round_trip(pages.repartition(3)).cache()
    assert sorted(map(tuple, warc.summary(chunks).collect()), key=repr) == expected_pages()
    whole = defaultdict(dict)
    for r in chunks.where("record_type = 'response'").collect():
        assert len(r["chunk"]) <= warc.CHUNK
        whole[r["page_id"]][r["chunk_no"]] = bytes(r["chunk"])
    for i, _, h in PAGES:
        if i in whole:
            assert b"".join(whole[i][n] for n in sorted(whole[i])) == (h or "").encode()
    assert warc.summary(warc.round_trip(pages.limit(0))).count() == 0


def test_archives_do_not_depend_on_how_chunks_meet_revisits(spark):
    pages = spark.createDataFrame(PAGES * 2, "page_id long, url string, html string").repartition(5)
    told = {}
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            chunks = warc.chunked(warc.records(pages))
            told[limit] = sorted(map(tuple, warc.summary(warc.round_trip(pages)).collect()), key=repr)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # A page is not shuffled whole, and a revisit not at all beyond its first chunk.
        assert max(len(r["chunk"]) for r in chunks.collect()) <= warc.CHUNK
        assert {r["chunk_no"] for r in chunks.where("record_type = 'revisit'").collect()} == {0}
    assert told["10MB"] == told["-1"] == sorted(expected_pages() * 2, key=repr)


def test_archives_are_gzip_members_with_standard_headers(spark):
    pages = spark.createDataFrame(PAGES[:5], "page_id long, url string, html string").coalesce(1)
    folder = scratch_path(spark, "warc-test")
    index = warc.write(warc.chunked(warc.records(pages).coalesce(1)), folder, archive_bytes=1)
    rows = index.collect()
    assert len({r["archive"] for r in rows}) == 5  # a new archive after every record
    for r in rows:
        data = open(r["archive"].removeprefix("file:"), "rb").read()[r["place"] : r["place"] + r["size"]]
        record = zlib.decompress(data, 31)
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
        head, _, rest = record.partition(b"\r\n\r\n")
        assert int(re.search(rb"Content-Length: (\d+)", head)[1]) == len(rest) - 4
        assert not re.search(rb"^Evil", head, re.M)


def test_a_stream_of_several_records_is_read_in_pieces():
    row = {"page_id": 1, "url": "u", "payload_bytes": 200_000, "payload_digest": hashlib.sha1(b"ab" * 100_000).hexdigest(), "record_type": "response", "refers_to": None}
    pack = lambda data: (c := zlib.compressobj(6, zlib.DEFLATED, 31)).compress(data) + c.flush()
    data = pack(warc.header(row) + b"ab" * 100_000 + b"\r\n\r\n") * 3
    out = list(warc.read_records(io.BytesIO(data), len(data)))
    assert [r[5] for r in out] == [0, 1, 2, 3] * 3
    assert [r[9] for r in out] == [False, False, False, True] * 3
    assert out[3][8] == row["payload_digest"] and out[3][7] == 200_000
    assert out[0][8] == hashlib.sha1(b"ab" * 32768).hexdigest()


def test_warc_query_equals_sql(spark):
    assert compare(spark, connect(MEDIUM), MEDIUM, QUERIES["op6_warc"], ORACLES["op6_warc"]) is None


def license_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute_licenses(rows, least=licenses.LEAST):
    cut = lambda w: {" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()
    out = {}
    for doc, text in rows:
        w = license_words(text)
        for name, notice in licenses.TEMPLATES:
            t = license_words(notice)
            step = max(1, len(t) // licenses.STEPS)
            for first in range(0, len(w), step):
                share = len(cut(w[first : first + len(t) + step - 1]) & cut(t)) / len(cut(t))
                if share >= least:
                    n, f, c = out.get((doc, name), (0, first, 0.0))
                    out[doc, name] = (n + 1, min(f, first), max(c, share))
    return sorted((d, n, *v) for (d, n), v in out.items())


def test_licenses_against_brute_force(spark):
    apache = licenses.TEMPLATES[3][1]
    rows = [(1, "abc. Released under the MIT License. def"), (1, "RELEASED UNDER THE MIT LICENSE!"), (2, None), (3, ""), (4, "the license"), (5, "MIT License")]
    rows += [(6, "word " * 5000 + apache + " word" * 5000), (7, apache.replace("except", "but").replace("copy", "text")), (8, apache[:60]), (9, " ".join(t for _, t in licenses.TEMPLATES))]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, length int, key string")
    got = sorted(tuple(r) for r in licenses.scan(docs).collect())
    assert [g[:2] for g in got] == [b[:2] for b in brute_licenses(rows)]
    assert [(g[0], g[1], g[4]) for g in got] == [(b[0], b[1], b[4]) for b in brute_licenses(rows)]
    assert licenses.scan(docs.limit(0)).count() == 0


def test_licenses_of_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op1_license_scan"](spark, SMALL).collect())
    assert got == brute_licenses(rows) and got


def test_sibling_licenses_are_told_apart(spark):
    gnu = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version. It is distributed in the hope"
    rows = {
        "GPL-2.0-or-later": gnu.format("General Public", "2"),
        "GPL-3.0-or-later": gnu.format("General Public", "3"),
        "LGPL-2.0-or-later": gnu.format("Library General Public", "2"),
        "LGPL-2.1-or-later": gnu.format("Lesser General Public", "2.1"),
        "LGPL-3.0-or-later": gnu.format("Lesser General Public", "3"),
        "AGPL-3.0-or-later": gnu.format("Affero General Public", "3"),
        "GPL-2.0": "This work is licensed under the GNU General Public License, version 2. Enjoy",
        "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3. Enjoy",
        "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    }
    docs = spark.createDataFrame([(n, f"{'word ' * n}{text} and more") for n, text in enumerate(rows.values())], "doc_id long, text string")
    both = spark.createDataFrame([(99, rows["GPL-2.0-or-later"] + " Released under the MIT License. " + rows["AGPL-3.0-or-later"])], docs.schema)
    got = sorted((r["doc_id"], r["license"]) for r in licenses.scan(docs.union(both)).collect())
    assert got == [*enumerate(rows), (99, "AGPL-3.0-or-later"), (99, "GPL-2.0-or-later"), (99, "MIT")]


def test_no_python_in_the_license_scan(spark):
    plan = QUERIES["op1_license_scan"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_without_dropout_the_library_agrees(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoder = dropout_bpe.MergeEncoder(MODEL, dropout=0)
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect():
        for line in r["text"].split("\n"):
            line = " ".join(line.split())
            assert encoder.encode(" " + line).tolist() == model.encode(line) or not line


ODD = [None, "", " ", "  a  b ", "▁ ▁▁x y▁", "tab\tline\r\n\n", "日本 \U0001f600 é", "a" * 3000, "\u0000  ", "word " * 20_000]


def test_dropout_varies_and_decodes(spark):
    docs = spark.createDataFrame([(i if i != 4 else None, t, 1) for i, t in enumerate(ODD + [ODD[3]])], "doc_id long, text string, ids int")
    encoded = dropout_bpe.encode(docs, MODEL, dropout=0.4)
    back = {r["doc_id"]: r["text"] for r in dropout_bpe.decode(encoded, MODEL).collect()}
    for i, t in enumerate(ODD):
        assert back[i if i != 4 else None] == t
    rows = {r["doc_id"]: r for r in encoded.collect()}
    assert rows[0]["ids"] is None and rows[1]["ids"] == []
    again = {r["doc_id"]: r["ids"] for r in dropout_bpe.encode(docs.repartition(4), MODEL, dropout=0.4).collect()}
    assert again == {d: r["ids"] for d, r in rows.items()}
    other = {r["doc_id"]: r["ids"] for r in dropout_bpe.encode(docs, MODEL, dropout=0.4, seed=5).collect()}
    assert other[9] != again[9]
    assert len(dropout_bpe.MergeEncoder(MODEL, 1.0).encode("hello")) == 5
    words = [bytes(x) for x in np.array_split(np.array(rows[9]["ids"], "<u4"), 1)]
    assert words and len({tuple(dropout_bpe.MergeEncoder(MODEL, 0.4).encode(" international", s).tolist()) for s in range(4)}) > 1


def test_short_and_long_words_agree():
    import random

    rnd, encoder = random.Random(1), dropout_bpe.MergeEncoder(MODEL, 0.3)
    for n in range(3000):
        word = " " * rnd.randrange(3) + "".join(rnd.choice("abetionshérß,.日1") for _ in range(rnd.randrange(1, 30)))
        key = zlib.crc32(word.encode(), (encoder.seed * 0x9E3779B1 + n % 4) & 0xFFFFFFFF)
        assert encoder.merge(word, n % 4) == encoder.merge_long(word, key), word


def test_every_occurrence_has_its_own_draws(spark):
    encoder = dropout_bpe.MergeEncoder(MODEL, 0.4)
    word = " international"
    within = encoder.encode(word * 400)
    rows = spark.createDataFrame([(i, word) for i in range(400)], "doc_id long, text string")
    between = {tuple(r["ids"]) for r in dropout_bpe.encode(rows, MODEL, dropout=0.4).collect()}
    alone = {encoder.merge(word, n) for n in range(400)}
    assert encoder.decode(within.tolist()) == word * 400
    # More than any small number of variants: as many as with a draw per candidate.
    assert len(alone) > 30 and 0.7 < len(between) / len(alone) < 1.4


def test_remembered_words_equal_words_merged_alone():
    import random

    rnd, encoder = random.Random(2), dropout_bpe.MergeEncoder(MODEL, 0.2)
    words = [" " + "".join(rnd.choice("abetionsh") for _ in range(rnd.randrange(1, 12))) for _ in range(40)] + ["é" * 60, " ▁a", "\n", "   "]
    parts = [rnd.choice(words) for _ in range(4000)]
    keys = np.array([rnd.getrandbits(32) for _ in parts], np.uint32)
    ids, sizes = encoder.merge_all(parts, keys)
    expected = [encoder.merge_long(p, int(k)) for p, k in zip(parts, keys)]
    assert ids.tobytes() == b"".join(expected) and sizes.tolist() == [len(e) // 4 for e in expected]


def test_dropout_query(spark):
    got = QUERIES["op3_merge_dropout"](spark, SMALL)
    assert got.count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert got.where("lossless").count() == got.count()


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = spark.createDataFrame(
        [(90_001, None, "en", "s", 0), (90_002, "", "en", None, 0), (90_003, "123 !!", None, "s", 7), (None, "Is and of the with", "en", "s", 9)], docs.schema
    )
    docs = docs.union(extra)
    before = docs.count()
    name, stage = corpus_pipeline.STAGES[0]
    assert name == "language_id"
    known = stage(spark, docs, SMALL)
    assert known.schema.names == docs.schema.names and known.count() == before - 3
    single = corpus_pipeline.one_of_near_copies(spark, known, SMALL).cache()
    assert single.schema.names == docs.schema.names
    # Of one group of near copies one document stays, so a second run finds nothing more.
    assert corpus_pipeline.one_of_near_copies(spark, single, SMALL).count() == single.count() < known.count()
    cut = corpus_pipeline.without_repeated_passages(spark, single, SMALL).cache()
    assert cut.dtypes == docs.dtypes and cut.count() == single.count()
    assert cut.where("n_chars <> length(text)").count() == 0
    same = cut.join(single.select("doc_id", F.col("text").alias("old")), "doc_id")
    assert same.where("text = old").count() > 0 and same.where("length(text) < length(old)").count() > 0
    clean = corpus_pipeline.without_personal_data(spark, cut, SMALL).cache()
    assert clean.dtypes == docs.dtypes and clean.count() == cut.count()
    assert clean.where("text rlike '[a-z0-9]@mail[0-9]'").count() == 0 and clean.where("text like '%[email]%'").count() > 0
    pieces = corpus_pipeline.packed(spark, clean, SMALL)
    assert pieces.select("doc_id").distinct().count() == clean.select("doc_id").distinct().count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


@pytest.mark.parametrize("count", [2, 20])
def test_the_cut_on_language_does_not_depend_on_their_number(spark, count):
    import random

    rnd, letters = random.Random(3), "abcdefghijklmnopqrstuvwxyz"
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").where("n_chars > 300 and lang is not null").orderBy("doc_id")
    texts = {name: [r["text"] for r in docs.where(F.col("lang") == name).limit(40).collect()] for name in ("en", "de")}
    rows = []
    for n in range(count):
        # Related languages: some letters change places.
        own = random.Random(n // 2).sample(letters, 8 if n > 1 else 0)
        table = str.maketrans("".join(own), "".join(own[1:] + own[:1]))
        rows += [(1000 * n + i, t.lower().translate(table), f"l{n}", "s", 0) for i, t in enumerate(texts["en" if n % 2 else "de"])]
    noise = [(-1 - i, "".join(rnd.choice(letters + "   ") for _ in range(600)), None, "s", 0) for i in range(20)]
    kept = {r["doc_id"] for r in corpus_pipeline.known_language(spark, spark.createDataFrame(rows + noise, docs.schema), MEDIUM).collect()}
    assert kept == {r[0] for r in rows}


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert got.agg(F.sum("length")).first()[0] == got.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
