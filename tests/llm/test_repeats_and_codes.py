"""Repetition rules, periodic runs and pivot codes against brute force, with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SMALL
from oracle_check import compare, connect
from pyspark.sql import functions as F

from sluice.llm import periodic, pivot_codes, repetition
from sluice.llm.queries import ORACLES, QUERIES, with_planted_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, runs int, word_chars string, collapsed int"
BASE = " ".join(f"w{i}" for i in range(40))
ROWS = [
    (1, BASE),
    (2, None),
    (3, ""),
    (4, " \t\n \x0b"),
    (5, "one"),
    (6, "a " * 50),
    (6, "a b " * 30 + BASE),
    (None, (BASE + "\n") * 5),
    (7, "é　ü # " * 9 + "end"),
    (8, "x\ny\nx \nx\n\n\ny\n" + BASE),
    (9, " ".join(f"v{i % 977}x{i % 31}" for i in range(30_000))),
    (10, BASE + " " + " ".join(BASE.split()[:9]) + " tail"),
    (11, "q " + "a b c " * 7 + "a b d " + "a b " * 4 + "a b d"),
    (12, " ".join("abaababa"[i % 8] for i in range(100))),
    (13, " ".join(f"{i * i % 7}" for i in range(200))),
    (14, "z" * 300_000 + " " + "z " * 9),
]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "clash", 2) for i, t in rows], SCHEMA)


def key(row):
    return [("", v) if isinstance(v, str) else (v is None, v or 0) for v in row]


def brute_repetition(text):
    text = text or ""
    words = WORD.findall(text)

    def inside(n, skip):
        times, seen, out = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)), set(), set()
        for i in range(len(words) - n + 1):
            gram = tuple(words[i : i + n])
            if times[gram] > 1 and (not skip or gram in seen):
                out.update(range(i, i + n))
            seen.add(gram)
        return out

    lines, known = [], set()
    for line in text.split("\n"):
        if WORD.search(line) and line in known:
            lines.append(sum(map(len, WORD.findall(line))))
        known.add(line)
    chars = sum(map(len, words))
    repeat = len(inside(8, False))
    failed = len(words) < 20 or 100 * repeat > 30 * len(words)
    grams = {n: sum(len(words[i]) for i in inside(n, True)) for n in range(5, 11)}
    over = 100 * sum(lines) > 20 * chars or any(100 * grams[n] > repetition.GRAM_SHARES[n] * chars for n in grams)
    return (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), len(lines), repeat, failed, not failed and not over)


def test_repetition_against_brute_force(spark):
    got = repetition.judge(repetition.measure(frame(spark, ROWS)))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert sorted(map(tuple, got.select(names).collect()), key=key) == sorted(((i, *brute_repetition(t)) for i, t in ROWS), key=key)


def test_windows_whose_hashes_meet_stay_apart():
    rng = np.random.default_rng(5)
    codes = rng.integers(0, 4, 400)
    same = np.zeros(4, np.uint64)  # all hashes are equal
    sizes = np.array([150, 250])
    own = {n: (a, b) for n, a, b in repetition.gram_coverage(codes, same, sizes, range(3, 6))}
    apart = {n: (a, b) for n, a, b in repetition.gram_coverage(codes, rng.integers(0, 2**63, 4).astype(np.uint64), sizes, range(3, 6))}
    assert all((own[n][0] == apart[n][0]).all() and (own[n][1] == apart[n][1]).all() for n in own)


def test_other_window_lengths(spark):
    got = repetition.measure(frame(spark, ROWS[9:12]), shares={3: 20, 8: 10}).select("gram_chars").collect()
    assert all(len(r[0]) == 2 and r[0][0] >= r[0][1] for r in got)
    with pytest.raises(ValueError):
        repetition.measure(frame(spark, ROWS[:1]), shares={3: 20, 5: 10})


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q), q)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_against_brute_force(spark):
    got = periodic.periodic_runs(frame(spark, ROWS)).collect()
    expected = []
    for i, text in ROWS:
        words = WORD.findall(text or "")
        # The long text repeats nothing; brute force would take its square.
        runs = [] if i == 9 else brute_runs(words)
        expected.append((i, len(words), runs, brute_collapsed(words, runs)))
    plain = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]
    assert sorted(plain, key=lambda r: (r[0] is None, r[0] or 0, r[3])) == sorted(expected, key=lambda r: (r[0] is None, r[0] or 0, r[3]))


def test_runs_of_many_small_texts():
    rng = np.random.default_rng(7)
    fibonacci = ["0", "01"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    for _ in range(60):
        texts = [np.array([int(c) for c in fibonacci[-1][: rng.integers(1, 200)]])]
        for _ in range(6):
            kinds, size = int(rng.choice([1, 2, 3, 5, 30])), int(rng.integers(0, 90))
            texts.append(rng.integers(0, kinds, size))
            texts.append(np.concatenate([np.tile(rng.integers(0, kinds, int(rng.integers(1, 9))), int(rng.integers(1, 9))) for _ in range(4)]))
        found = [[] for _ in texts]
        for of, *run in zip(*(c.tolist() for c in periodic.runs_of(np.concatenate(texts), np.array([len(t) for t in texts])))):
            found[of].append(tuple(run))
        assert found == [brute_runs(t.tolist()) for t in texts]


def test_the_grammar_derives_its_texts():
    """Every symbol of a round stands for two neighbours, at each of its places the same words."""
    rng = np.random.default_rng(2)
    words = np.concatenate([np.tile(rng.integers(0, 5, 11), 9), rng.integers(0, 3, 300)])
    fresh = np.append(np.ones(len(words) - 1, bool), False)
    s = periodic.Symbols(words.copy(), np.zeros(len(words), np.int64), np.arange(len(words)), np.ones(len(words), np.int64), fresh)
    rounds = 0
    while (made := periodic.round_of_pairs(s)) is not None:
        left, pair, first = made
        assert (np.bincount(pair) >= 2).all() and (np.diff(left) > 1).all()
        for n, p in zip(left, pair):
            a, b = left[first[p]], n
            size = s.size[a] + s.size[a + 1]
            assert (words[s.start[a] : s.start[a] + size] == words[s.start[b] : s.start[b] + size]).all() and size == s.size[b] + s.size[b + 1]
        s.code[left] = int(s.code.max()) + 1 + pair
        s = periodic.joined_symbols(s, left)
        rounds += 1
    assert rounds > 3 and s.size.sum() == len(words)
    pairs = list(zip(s.code[:-1].tolist(), s.code[1:].tolist()))
    assert all(pairs.count(p) == 1 or p[0] == p[1] for p in pairs)


def test_run_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for doc, text in docs:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute_runs(words)
        r = got[doc]
        sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert (r["n_runs"], r["runs_sha256"]) == (len(runs), sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)))
        assert r["collapsed_sha256"] == sha(brute_collapsed(words, runs))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        expected = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == expected
    assert planted > 5


def test_planting_leaves_odd_rows_alone(spark):
    assert {(r[0], r[1]) for r in with_planted_runs(frame(spark, [(None, "a b"), (21, None), (21, "")])).collect()} == {(None, "a b"), (21, None), (21, "")}


VECTORS = "vec_id long, embedding array<double>, label int, code string, x int"


def some_vectors():
    rng = np.random.default_rng(3)
    base = rng.normal(scale=0.4, size=(20, 8))
    rows = [(i, (base[i % 20] + rng.normal(scale=0.01 * (i % 9), size=8)).tolist(), None if i % 7 == 0 else i % 3) for i in range(260)]
    rows += [(7, rows[9][1], 0), (None, base[0].tolist(), 4), (300, None, 1), (301, [math.nan] * 8, 1), (302, [1.0, None] * 4, 1), (303, [math.inf] * 8, 1)]
    return [*rows, (304, [0.0] * 8, 5), (305, [1e200] * 8, 5), (306, [0.5] * 4, 5), (-1, [], 2), (308, [3e5, -3e5] * 4, None)]


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    usable = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in kept if len(v) == 8 and max(map(abs, v)) < 1e5 * 3.5]
    usable.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[x[1][p * 2 : p * 2 + 2] for p in range(parts)] for x in usable]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(v, book):
        return min((sum((a - b) ** 2 for a, b in zip(v, e)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            for n, ms in members.items():
                books[p][n] = [sum(x) // len(ms) for x in zip(*ms)]
    out = []
    for (i, _, label), c in zip(usable, cut):
        near = [nearest(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{n:02x}" for _, n in near), sum(d for d, _ in near), label))
    out += [(i, None, None, label) for i, v, label in kept if not (len(v) == 8 and max(map(abs, v)) < 1e5 * 3.5)]
    sums = {}
    for _, _, error, label in out:
        if error is not None:
            sums[label] = sums.get(label, 0) + error
    return [(i, code, error, sums.get(label)) for i, code, error, label in out], books


@pytest.mark.parametrize("entries, few", [(256, 10_000), (16, 10_000), (16, 1)])
def test_codes_against_brute_force(spark, monkeypatch, entries, few):
    rows = some_vectors()
    table = spark.createDataFrame([(i, v, label, "clash", 3) for i, v, label in rows], VECTORS).repartition(5)
    if few == 1:
        monkeypatch.setattr(pivot_codes, "with_label_errors", lambda out, keep=pivot_codes.with_label_errors: keep(out, 4, few))
    got, books = pivot_codes.compress(table, entries=entries)
    expected, expected_books = brute_codes(rows, entries=entries)
    order = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted(map(tuple, got.select("vec_id", "code", "error", "label_error").collect()), key=order) == sorted(expected, key=order)
    assert books.tolist() == expected_books


def test_bounds_exclude_no_nearest_entry():
    rng = np.random.default_rng(11)
    for scale in (3, 1000, 1 << 27):
        parts, entries = rng.integers(-scale, scale, (500, 3)), rng.integers(-scale, scale, (70, 3))
        entries[40] = entries[3]
        pivots = entries[:5]
        got, far = pivot_codes.nearest_entries(parts, np.sqrt(pivot_codes.distances(parts, pivots).astype(float)), entries, pivots)
        exact = pivot_codes.distances(parts, entries)
        assert (got == exact.argmin(axis=1)).all() and (far == exact.min(axis=1)).all()


@pytest.mark.parametrize("name", ["op11_repetition", "op13_pivot_codes"])
def test_queries_equal_sql(spark, name):
    assert compare(spark, connect(SMALL), SMALL, QUERIES[name], ORACLES[name]) is None


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert repetition.judge(repetition.measure(docs)).count() == 0
    assert periodic.periodic_runs(docs).count() == 0
    got, books = pivot_codes.compress(spark.createDataFrame([], VECTORS))
    assert got.count() == 0 and books.size == 0 and got.columns == ["vec_id", "label", "code", "error", "label_error"]
    only_bad = spark.createDataFrame([(1, [1.0] * 3, 1, "", 1), (2, [math.nan], 1, "", 1)], VECTORS)
    assert [tuple(r) for r in pivot_codes.compress(only_bad)[0].collect()] == [(1, 1, None, None, None)]


def test_nothing_is_shuffled_for_texts(spark):
    plan = periodic.periodic_runs(frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "Exchange" not in repetition.measure(frame(spark, ROWS)).select(F.col("n_words"))._jdf.queryExecution().executedPlan().toString()
