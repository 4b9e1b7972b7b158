"""Language identification with bit-sliced Bloom filters over character n-grams.

One filter holds all languages: every slot is a bit mask with a bit per language, so the AND over
the slots of an n-gram gives all languages that have it at once. A text is given the language with
the most n-grams after the hits that the filter's false positives explain are taken off.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sluice.llm.words import chunks, mixed

LENGTHS = (3, 4)
# The bounds of the fit: documents sampled per language (expected), n-grams kept per language, and languages.
SAMPLE_DOCS, GRAMS, LANGUAGES = 2000, 4000, 1000
SLOTS, PROBES = 1 << 20, 3
UNKNOWN = "und"
# Characters that are counted together; it bounds the memory of a worker.
PIECE = 1 << 19


@functools.cache
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams, the text each belongs to (ascending), and which texts have a letter.

    Letters are lowered; whatever stands between them counts as one blank, also at both ends.
    """
    lowered = [f" {t.lower()} " if t else " " for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lowered)), np.fromiter(map(len, lowered), np.int64, len(lowered)))
    letter = letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the blank after a word
    keep[:-1] |= letter[1:] & (np.diff(owner, prepend=-1)[:-1] != 0)  # the blank before the first
    some = np.bincount(owner[letter], minlength=len(texts)) > 0
    if len(keep):
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        keep[starts] = some[owner[starts]]
    value = np.where(letter, points, 32)[keep].astype(np.uint64)
    owner = owner[keep]
    hashes, owners = [], []
    for n in LENGTHS:
        count = max(0, len(value) - n + 1)
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(0x1FFFFF) + value[i : i + count]
        inside = owner[:count] == owner[n - 1 : n - 1 + count]
        hashes.append(mixed(h[inside] * np.uint64(0x9E3779B97F4A7C15)))
        owners.append(owner[:count][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(hashes)[order], owner[order], some


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """The text in pieces of at most ``most`` characters, cut at a blank where there is one."""
    begin = 0
    while len(text) - begin > most:
        cut = max(text.rfind(c, begin + 1, begin + most + 1) for c in " \n")
        cut = cut if cut > begin else begin + most
        yield text[begin:cut]
        begin = cut
    yield text[begin:]


def batched(parts: list[tuple[int, str]], most: int) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for part in parts:
        if held and size + len(part[1]) > most:
            yield held
            held, size = [], 0
        held.append(part)
        size += len(part[1])
    if held:
        yield held


def slots(hashes: np.ndarray, count: int) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) % np.uint64(count)).astype(np.int64) for i in range(PROBES)]


class Filters:
    """The filters of all languages in one array per 64 of them."""

    def __init__(self, by_language: dict[str, np.ndarray], size: int = SLOTS):
        self.names = list(by_language)
        self.size = size
        self.planes = np.zeros((-(-len(self.names) // 64), size), np.uint64)
        self.false = np.zeros(len(self.names))
        for n, hashes in enumerate(by_language.values()):
            bit = np.uint64(1) << np.uint64(n % 64)
            for at in slots(hashes, size):
                self.planes[n // 64, at] |= bit
            self.false[n] = ((self.planes[n // 64] & bit) != 0).mean() ** PROBES

    def languages_of(self, hashes: np.ndarray) -> np.ndarray:
        """A mask per n-gram and plane: all languages that (seem to) have it."""
        masks = None
        for at in slots(hashes, self.size):
            masks = self.planes[:, at] if masks is None else masks & self.planes[:, at]
        return masks

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        return self.measured(texts)[:2]

    def measured(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, its share of all corrected hits, and its corrected hits over all n-grams of the text."""
        # Long texts are counted piece by piece.
        parts = [(d, part) for d, t in enumerate(texts) if t for part in pieces(t)]
        total, hits, some = np.zeros(len(texts)), np.zeros((len(texts), len(self.names))), np.zeros(len(texts), bool)
        for group in batched(parts, PIECE):
            rows = np.array([d for d, _ in group])
            hashes, owner, letter = grams([t for _, t in group])
            owner, some[rows[letter]] = rows[owner], True
            total += np.bincount(owner, minlength=len(texts))
            masks = self.languages_of(hashes)
            for n in range(len(self.names)):
                has = (masks[n // 64] >> np.uint64(n % 64)) & np.uint64(1)
                hits[:, n] += np.bincount(owner[has.astype(bool)], minlength=len(texts))
        true = np.clip((hits - total[:, None] * self.false) / (1 - self.false), 0, None)
        best = true.argmax(axis=1)
        all_hits = true.sum(axis=1)
        share = np.divide(true[np.arange(len(texts)), best], all_hits, out=np.zeros(len(texts)), where=all_hits > 0)
        names = [self.names[b] if s else UNKNOWN for b, s in zip(best.tolist(), some.tolist())]
        evidence = true[np.arange(len(texts)), best] / np.maximum(total, 1)
        return names, np.where(some, share, 0.0), np.where(some, evidence, 0.0)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS, kept: int = GRAMS, most: int = LANGUAGES) -> Filters | None:
    """Learn from the rows with a text and a language; ``None`` if there are none.

    About ``sample_docs`` rows of each language are used, chosen by a hash of their text, whole; a
    language keeps its ``kept`` most frequent n-grams. The ``most`` languages with the most rows are learned (of equal ones the first
    by name), so what reaches the driver is bounded, also where the column holds anything else than languages.
    """
    known = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    ordered = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most)
    counts = {r["lang"]: r["n"] for r in ordered.collect()}
    if not counts:
        return None
    languages = sorted(counts, key=lambda name: (-counts[name], name))
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, sample_docs / counts[name]))])
    known = known.where(F.col("lang").isin(languages))
    sample = known.where((F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / (1 << 20)) < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", PIECE):
            hashes, owner, _ = grams(batch.column("text").to_pylist())
            names = np.array(batch.column("lang").to_pylist())[owner]
            for name in np.unique(names):
                values, n = np.unique(hashes[names == name], return_counts=True)
                yield pa.record_batch(
                    {"lang": pa.array([str(name)] * len(values)), "gram": pa.array(values.view(np.int64)), "n": pa.array(n)}
                )

    often = sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = often.withColumn("place", F.row_number().over(order)).where(F.col("place") <= kept).select("lang", "gram").collect()
    by_language: dict[str, list[int]] = {name: [] for name in languages}
    for row in best:
        by_language[row["lang"]].append(row["gram"])
    return Filters({name: np.array(sorted(g), np.int64).view(np.uint64) for name, g in by_language.items()})


def identify(docs: DataFrame, filters: Filters | None, text: str = "text", evidence: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` in place of columns of these names.

    ``evidence`` names a further column: the language's corrected hits over all n-grams of the text,
    which does not depend on the other languages.

    ``lang_pred`` is ``und`` and the score 0 for a null text, a text without a letter, and if nothing
    was learned. A text with letters always gets a language, at a tie the one with more training rows. The
    score is the language's share of all corrected hits.
    """
    added = ["lang_pred", "score", *([evidence] if evidence else [])]
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            texts = batch.column(text).to_pylist()
            if shared.value is None:
                found = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
            else:
                found = shared.value.measured(texts)
            for name, values in zip(added, found):
                batch = batch.append_column(name, pa.array(values))
            yield batch

    kinds = T.StructType([*docs.schema.fields, *(T.StructField(n, T.StringType() if n == "lang_pred" else T.DoubleType()) for n in added)])
    return docs.mapInArrow(predict, kinds)


def held_out(doc_id: str = "doc_id"):
    """Every fifth document by the CRC of its id is kept from training; a null id is not."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
