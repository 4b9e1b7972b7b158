"""Operators on documents against brute force, with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from oracle_check import compare, connect
from pyspark.sql import functions as F

from sluice.llm import language, near_dedup, packing, personal_data, substring_dedup
from sluice.llm.queries import ORACLES, QUERIES

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, bucket int, spans string, n int"
BASE = " ".join(f"w{i}" for i in range(60))
LONG = " ".join(f"v{i % 977}x{i % 31}" for i in range(30_000))

ROWS = [
    (1, BASE),
    (2, BASE),
    (2, BASE + " tail"),
    (3, None),
    (4, ""),
    (5, " \t\n "),
    (6, "Short one"),
    (7, "short ONE"),
    (8, LONG),
    (9, LONG + " more words at the end"),
    (None, BASE),
    (10, "x " * 40),
    (11, "x " * 41),
    (12, "é　ü " + BASE.replace("w30", "other")),
    (13, BASE + " " + BASE),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", 2) for i, t in rows], SCHEMA)


def brute_repeats(rows, window=13):
    seen = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1) if doc is not None else ():
            key = tuple(words[i : i + window])
            seen[key] = min(doc, seen.get(key, doc))
    out = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1) if doc is not None else ():
            if seen[tuple(words[i : i + window])] < doc:
                gone.update(range(i, i + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_share", [1e-4, 0.0])
def test_repeats_against_brute_force(spark, hot_share):
    got = substring_dedup.remove_repeats(frame(spark, ROWS), hot_share=hot_share or 1e-3).collect()
    assert sorted(map(tuple, got), key=repr) == brute_repeats(ROWS)


def test_windows_of_frequent_minimisers_travel_alone(spark, monkeypatch):
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i} g{i} " + BASE + f" k{i} l{i} m{i % 7} n{i} o{i}") for i in range(150)] + ROWS
    real = substring_dedup.frequent
    seen = []

    def low(docs, window, part, share):
        seen.append(real(docs, window, part, 0.003))
        return seen[-1]

    monkeypatch.setattr(substring_dedup, "frequent", low)
    got = substring_dedup.remove_repeats(frame(spark, rows).repartition(7)).collect()
    assert seen[0][0]
    assert sorted(map(tuple, got), key=repr) == brute_repeats(rows)


def test_words_are_hashed_in_blocks_wherever_they_stand(monkeypatch):
    words = ["a", "b", "ab", "a\0", "12345678", "123456789", "é" * 9, "中" * 30, *("x" * n for n in range(3, 200))]
    at_once = substring_dedup.block_hashes(pa.array(words, pa.large_string()))
    assert len(set(at_once.tolist())) == len(words)
    alone = [int(substring_dedup.block_hashes(pa.array([w], pa.string()))[0]) for w in words]
    assert alone == at_once.tolist() == substring_dedup.block_hashes(pa.array(["skipped", *words, "z"]).slice(1, len(words))).tolist()
    assert len(substring_dedup.block_hashes(pa.array([], pa.large_string()))) == 0
    one_by_one = []
    monkeypatch.setattr(substring_dedup, "word_hashes", lambda w, f=substring_dedup.word_hashes: one_by_one.append(len(w)) or f(w))
    substring_dedup.Windows(pa.array([" ".join(words)] * 3), 13, 2)
    assert one_by_one == [sum(len(w.encode()) > substring_dedup.LONG_WORD for w in words)]


def test_windows_that_share_a_hash_stay_apart():
    import numpy as np

    codes = np.array([0, 1, 2, 3, 0, 1, 2, 3])
    at = np.arange(6)
    order, new = substring_dedup.grouped(codes, np.zeros(6, np.uint64), at, 3)
    groups = [sorted(g.tolist()) for g in np.split(order, np.flatnonzero(new)[1:])]
    assert sorted(groups) == [[0, 4], [1, 5], [2], [3]]


def shingles(text, words):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute_components(rows, words, similar, of=100):
    sets = defaultdict(list)
    for doc, text in rows:
        sets[doc].append(shingles(text, words))
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = [d for d in sets if d is not None]
    for a in ids:
        for b in ids:
            if a < b and any(x and y and of * len(x & y) >= similar * len(x | y) for x in sets[a] for y in sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    out = []
    for doc, text in rows:
        c = None if doc is None else root(doc)
        out.append((doc, len(shingles(text, words)), c, None if doc is None else doc == c))
    return sorted(out, key=repr)


def edited(text, places, tag):
    words = text.split()
    for p in places:
        words[p] = f"{tag}{p}"
    return " ".join(words)


def test_near_duplicates_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    rows = list(ROWS)
    for i in range(100, 190):  # one group around the threshold, with members that link to a few others only
        rows.append((i, edited(LONG[:1200], rnd.sample(range(120), rnd.randrange(1, 9)), f"t{i}")))
    got = near_dedup.near_duplicates(frame(spark, rows).repartition(5), words=3, similar=85).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows, 3, 85)


def test_the_wider_shingles_of_the_pipeline(spark):
    got = near_dedup.near_duplicates(frame(spark, ROWS)).collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(ROWS, 5, 80)


def test_estimates_follow_the_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    b = np.unique(np.concatenate([a[: len(a) // 2], rng.integers(0, 2**63, 2000, dtype=np.uint64)]))
    regs = near_dedup.registers(np.concatenate([a, b]), np.array([len(a), len(b)]), 2000)
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    chance = near_dedup.by_chance()
    assert 1e-4 < chance < 2.5e-4
    assert abs(((regs[0] == regs[1]).mean() - chance) / (1 - chance) - true) < 0.05


@pytest.mark.parametrize("key", ["op7_near_dedup", "op10_substring_dedup"])
def test_queries_equal_sql(spark, key):
    assert compare(spark, connect(MEDIUM), MEDIUM, QUERIES[key], ORACLES[key]) is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.remove_repeats(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert language.identify(none, language.fit(none.withColumn("lang", F.lit("en")))).count() == 0
    assert personal_data.find(none, personal_data.fit(none)).count() == 0
    assert packing.pack_documents(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_languages_of_held_out_documents(spark):
    got = QUERIES["op4_language_id"](spark, MEDIUM)
    truth = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    tested = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in tested) >= 0.97 * len(tested)


def test_languages_of_odd_texts(spark):
    train = spark.createDataFrame([("the house and the tree are here", "en", 1.0), ("das Haus und der Baum sind hier", "de", 2.0), ("null", None, None), (None, "fr", 0.0)], "text string, lang string, score double")
    filters = language.fit(train)
    assert filters.names == ["de", "en"]
    rows = [(1, "THE house"), (2, "der Baum"), (3, None), (4, ""), (5, "12 34 !!"), (6, "z"), (6, "z"), (7, "the tree " * 20_000)]
    got = [(r["doc_id"], r["lang_pred"]) for r in language.identify(frame(spark, rows), filters).collect()]
    assert got[:5] == [(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und")]
    assert {p for _, p in got[5:]} <= {"en", "de"} and got[-1] == (7, "en")
    assert [r["lang_pred"] for r in language.identify(frame(spark, rows[:1]), None).collect()] == ["und"]


def test_languages_against_exact_sets(spark):
    """The filters against plain sets of n-grams, made and counted in another way."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    train = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["text"] is not None and r["lang"] is not None]

    def grams(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        line = f" {' '.join(words)} " if words else ""
        return [line[i : i + n] for n in (3, 4) for i in range(len(line) - n + 1)]

    sets = defaultdict(set)
    for r in train:
        sets[r["lang"]].update(grams(r["text"]))
    filters = language.fit(docs.where(~language.held_out()), sample_docs=10**9, kept=10**9)
    texts = [r["text"] for r in rows]
    names, share, evidence = filters.measured(texts)
    for text, name, s, e in zip(texts, names, share, evidence):
        all_ = grams(text or "")
        hits = {lang: sum(g in known for g in all_) for lang, known in sets.items()}
        if not all_:
            assert name == "und"
            continue
        best = max(hits.values())
        assert hits[name] >= best - max(2, 0.02 * len(all_))
        assert abs(s - hits[name] / max(1, sum(hits.values()))) < 0.02 and abs(e - hits[name] / len(all_)) < 0.02


def test_only_so_many_languages_are_learned(spark):
    rows = [(f"word{i} text here", f"l{i % 40:02d}") for i in range(200)] + [("more of it", "l07")] * 3
    filters = language.fit(spark.createDataFrame(rows, "text string, lang string"), most=10)
    assert filters.names == ["l07", *[f"l{i:02d}" for i in range(10) if i != 7]]


def test_long_texts_are_cut_at_blanks():
    text = "ab cde\nf" * 50 + "x" * 30
    parts = list(language.pieces(text, 10))
    assert "".join(parts) == text and max(map(len, parts)) <= 10
    assert all(p[0] in " \n" for p in parts[1:40])


def test_bit_slices_return_every_language_of_an_ngram():
    import numpy as np

    names = {f"l{i}": np.arange(i, 400, 70, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) for i in range(70)}
    filters = language.Filters(names)
    assert filters.planes.shape[0] == 2
    for n, hashes in enumerate(names.values()):
        mask = filters.languages_of(hashes)[n // 64]
        assert ((mask >> np.uint64(n % 64)) & np.uint64(1)).all()


BASE_PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in s.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: 16 <= len(d := re.sub(r"[^0-9]", "", s)) <= 19 and luhn(d)),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 8 <= len(re.sub(r"[^0-9]", "", s)) <= 15),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in BASE_PATTERNS for m in p.finditer(text or "") if ok(m[0])]


ODD = [
    "a@b.c_d@e.f x@y@z.com @.c a..b%+@q-1.r.s.t mail: é.n@m.o, @@a.b a@b a@b. q@1.2.3.4",
    "1.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 01.002.0003.4 1.2.3 9.9.9.9x 1..2.3.4.5 00000255.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 41111111111111111 +1 (555) 123-4567 +1555 ++12345678 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "١٢@x.y 12" + "3" * 5000 + ".1.2.3 " + "a" * 5000 + "@",
    None,
    "",
]


def test_base_spans_equal_the_patterns(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(ODD)]
    found = personal_data.find(frame(spark, rows), personal_data.fit(docs)).collect()
    assert len(found) == len(rows)
    added = 0
    for (doc, text), r in zip(rows, found):
        base = brute_spans(text)
        assert r["base_spans"] == ",".join(base), doc
        n = Counter(s.split(":")[0] for s in base)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(n[k] for k in ("email", "ip", "card", "phone"))
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(base) <= set(spans)
        order = [(personal_data.KINDS.index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert order == sorted(order)
        for s in set(spans) - set(base):
            added += 1
            _, a, b = s.split(":")
            assert any(c.isdigit() or c == "@" for c in text[int(a) : int(b)])
    assert added


def test_repeated_tokens_share_their_label():
    import numpy as np

    field = personal_data.Field(np.zeros((personal_data.FEATURES, 5)), np.zeros((5, 5)), np.eye(5) * 3)
    graph = personal_data.Graph(["call 555123 now or later 555123", "555123"])
    field.unary[graph.features[0]] = 0
    clear = personal_data.slot("before ")
    field.unary[clear] = 0
    alone = field.beliefs(graph)
    assert np.allclose(alone, 0.2)
    field.unary[personal_data.slot("shape 6")] = [0, 0, 0, 0, 1]
    tied = field.beliefs(graph)
    assert graph.far.tolist() == [[0, 1]]
    assert tied[0, 4] > tied[2, 4] > 0.2


def test_evidence_crosses_a_document_of_any_length():
    import numpy as np

    field = personal_data.Field(np.zeros((personal_data.FEATURES, 5)), np.zeros((5, 5)), np.eye(5) * 6)
    text = "555123" + " a 555123" * 60
    graph = personal_data.Graph([text, "1 2"])
    field.unary[personal_data.slot("before ")] = 0
    field.unary[graph.features[0]] = 0
    last = graph.features[len(graph.spans) - 3]
    assert (np.diff(graph.far, axis=1) == 1).all() and len(graph.far) == 60
    own = personal_data.Field(field.unary, field.near, field.far)
    graph.features = graph.features.copy()
    graph.features[60, 0] = 4095  # the last of the repeated tokens is clear
    own.unary[4095] = [0, 0, 0, 0, 8]
    beliefs = own.beliefs(graph)
    assert (beliefs[:61, 4] > 0.5).all() and last is not None


def test_messages_give_the_marginals_of_a_chain():
    import itertools as it

    import numpy as np

    rng = np.random.default_rng(3)
    field = personal_data.Field(rng.normal(size=(personal_data.FEATURES, 5)), rng.normal(size=(5, 5)), rng.normal(size=(5, 5)))
    graph = personal_data.Graph(["1 22 333 x 1"])
    assert len(graph.near) == 2 and len(graph.far) == 1
    graph.near = graph.near[:1]  # 0-1 and 0-3: a tree, on which messages are exact
    own = field.unary[graph.features].sum(axis=1)
    exact = np.zeros((4, 5))
    for labels in it.product(range(5), repeat=4):
        score = sum(own[i, y] for i, y in enumerate(labels))
        score += sum(field.near[labels[a], labels[b]] for a, b in graph.near) + sum(field.far[labels[a], labels[b]] for a, b in graph.far)
        for i, y in enumerate(labels):
            exact[i, y] += np.exp(score)
    assert np.allclose(field.beliefs(graph), exact / exact.sum(axis=1, keepdims=True), atol=1e-3)


def test_overlaps_are_found_by_bisection():
    import random

    rnd = random.Random(4)
    spans = [(0, a, a + rnd.randrange(1, 30)) for a in (rnd.randrange(500) for _ in range(40))]
    taken = personal_data.Taken(spans)
    for _ in range(2000):
        a = rnd.randrange(540)
        b = a + rnd.randrange(1, 9)
        assert taken.meets(a, b) == any(x < b and a < y for _, x, y in spans)


def test_the_fit_takes_late_tokens_too(spark):
    rows = [(i, "word 12 " * 100 + f"mail a{i}@b{i}.org and 10.0.0.{i}") for i in range(60)]
    field = personal_data.fit(frame(spark, rows), sample_tokens=8)
    assert field.unary.shape == (personal_data.FEATURES, 5)
    found = personal_data.find(frame(spark, rows), field).collect()
    assert all((r["n_email"], r["n_ip"]) == (1, 1) for r in found)


def test_masking():
    assert personal_data.masked("mail a@b.c, ok", "email:5:10") == "mail [email], ok"
    assert personal_data.masked("abcdef", "email:1:3,ip:2:5") == "a[email]f"
    assert personal_data.masked(None, "") is None and personal_data.masked("x", "") == "x"


@pytest.mark.parametrize("lengths", [[], [4096], [4096, 3000, 1096, 1000, 96, 1, 1, 1], [7] * 2000])
def test_best_fit_is_the_tightest(lengths):
    where, offset = packing.best_fit(lengths, 4096)
    rooms = []
    for n, (w, o) in zip(lengths, zip(where, offset)):
        fitting = [r for r in rooms if r >= n]
        if fitting:
            assert rooms[w] == min(fitting) and o == 4096 - rooms[w]
            rooms[w] -= n
        else:
            assert w == len(rooms) and o == 0
            rooms.append(4096 - n)


def test_packing_of_documents(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = [None, "", " ", "a <|endoftext|> b", "A<|startoftext|>B, <|ENDOFTEXT|>. c<|endoftext|>d! <|x|> Éa. b.", "İstanbul é  x y\u0085z", "it's\nI'LL 'S 12 a\tb", "x" * 9000, LONG, "e ́"]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_000 + i, t) for i, t in enumerate(odd)]
    got = packing.pack_documents(frame(spark, rows), public_tokenizers.path("word_bpe_49k.json"), group_pieces=100).collect()
    ids = {d: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)), r["doc_id"]
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans, total in [(pieces[d], len(x)) for d, x in ids.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == total if total else at <= 4096
    assert sum(map(len, ids.values())) > 0.85 * 4096 * len(sequences)


def test_words_of_sliced_batches():
    import pyarrow as pa

    from sluice.llm.words import chunks, split_words

    texts = ["Ab  é\x85x\n", None, "", " ", "Çd\tF", "日本 \xa0 g", "one two  three"] * 9
    whole = pa.record_batch({"text": pa.array(texts)})
    seen = []
    for part in chunks(iter([whole.slice(2, 50), whole.slice(0, 0), whole.slice(52)]), "text", 12):
        words, sizes = split_words(part.column("text"))
        assert sizes.sum() == len(words)
        seen += [w.decode() for w in words.cast(pa.large_binary()).to_pylist()]
    assert seen == [w for t in texts[2:] for w in WORD.findall(t or "")]
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    sliced = pa.array(["skip É", *texts, "The END. it's"]).slice(1)
    for text, ids in zip([*texts, "The END. it's"], encoder(sliced)):
        assert ids.tolist() == [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_digest_of_the_kept_words(spark):
    got = {r["doc_id"]: r for r in QUERIES["op10_substring_dedup"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    for doc, words, gone, text in brute_repeats([(r["doc_id"], r["text"]) for r in docs]):
        r = got[doc]
        assert (r["n_words"], r["n_removed"], r["kept_sha256"]) == (words, gone, hashlib.sha256(text.encode()).hexdigest())
