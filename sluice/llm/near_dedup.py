"""Near-duplicate documents by HyperMinHash.

A document is the set of its word shingles. Each register keeps, for one hash function, the
smallest shingle hash in 16 bits: the count of leading zeros and the bits after the first one.
Bands of registers find the candidates; the share of equal registers, corrected for equal
registers by chance, estimates the similarity and drops pairs that lie clearly below the
threshold; the rest are confirmed on the full sets.

Pairs within a bucket are not listed. Texts of equal sets are one node from the start. Every
other member of a bucket is first held against the smallest one. Only where a bucket still falls
into several components are its members compared further, and only across components: sets of
similarity t share one of their ``n - ceil(t n) + 1`` rarest shingles, so an index on these
finds all pairs that are left.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import components, dropped, stored
from sluice.llm.words import chunks, coded, mixed, run_hashes, split_words, word_hashes

BANDS, ROWS = 32, 6
MANTISSA = 10
# Hashes that are worked on together.
BLOCK = 32_768
# Text that is worked on together; it bounds the memory of a worker.
BATCH_BYTES = 2 << 20
# The estimate may fall this many standard deviations short before a pair is dropped.
MARGIN = 5.0
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted, one text after the other; and their numbers."""
    lowered = pa.array([t and t.translate(LOWER) for t in texts.cast(pa.binary()).to_pylist()], pa.large_binary())
    flat, sizes = split_words(lowered.view(pa.large_string()))
    codes, distinct = coded(flat)
    hashes = word_hashes(distinct)[codes]
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = sizes[doc] - (np.arange(len(codes)) - first[doc])
    full = run_hashes(hashes, words)
    at = np.flatnonzero(left >= words)
    short = np.flatnonzero((sizes > 0) & (sizes < words))
    parts = [full[at], np.array([run_hashes(hashes[first[d] : first[d] + sizes[d]], int(sizes[d]))[0] for d in short], np.uint64)]
    owner = np.concatenate([doc[at], short])
    values = np.concatenate(parts)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=len(texts)).astype(np.int64)


def registers(values: np.ndarray, sizes: np.ndarray, count: int) -> np.ndarray:
    """``count`` compressed minimum hashes per set; sets must not be empty."""
    least = np.empty((count, len(sizes)), np.uint64)
    seeds = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    keys, shifts = seeds[:count] | np.uint64(1), seeds[count:]
    ends = np.cumsum(sizes)
    begin, done = ends - sizes, 0
    while done < len(sizes):  # blocks that stay in the processor's cache
        upto = max(done + 1, int(np.searchsorted(ends, begin[done] + BLOCK, "right")))
        block = values[begin[done] : ends[upto - 1]]
        at, h = begin[done:upto] - begin[done], np.empty_like(block)
        for i in range(count):
            np.multiply(block, keys[i], out=h)
            np.add(h, shifts[i], out=h)
            np.minimum.reduceat(h, at, out=least[i, done:upto])
        done = upto
    least = least.T
    # The exponent of the float gives the leading zeros; the low bits are dropped, so nothing rounds up.
    fraction, exponent = np.frexp((least >> np.uint64(11)).astype(np.float64))
    zeros = np.clip(53 - exponent, 0, 53)
    bits = (fraction * 2 ** (MANTISSA + 1)).astype(np.int64) & (2**MANTISSA - 1)
    return (zeros << MANTISSA | bits).astype(np.uint16)


def by_chance() -> float:
    """How often registers of unrelated sets agree: two minima fall into the same cell.

    The minima of n values are exponential with rate n; summed over cells of width
    ``2 ** -(zeros + 1 + MANTISSA)`` the chance is close to the integral below for every n.
    """
    x = np.linspace(1e-4, 40, 400_000)
    width = 2.0 ** (np.floor(np.log2(x)) - MANTISSA)
    return float(np.sum(np.exp(-2 * x) * width) * (x[1] - x[0]))


def sketches(docs: DataFrame, words: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, bands, registers``; no key, bands or registers without words."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BATCH_BYTES):
            values, sizes = shingle_sets(batch.column("text"), words)
            cut = np.cumsum(sizes)
            some = np.flatnonzero(sizes)
            keys, band, register = ([None] * len(sizes) for _ in range(3))
            if len(some):
                regs = registers(values, sizes[some], bands * rows)
                grid = regs.reshape(len(some), bands, rows).astype(np.uint64)
                h = np.zeros((len(some), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
                for r in range(rows):
                    h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, r])
                for n, d in enumerate(some.tolist()):
                    keys[d] = hashlib.blake2b(values[cut[d] - sizes[d] : cut[d]].tobytes(), digest_size=16).digest()
                    band[d], register[d] = h[n].view(np.int64), regs[n].tobytes()
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array(sizes, pa.int64()),
                    "set_key": pa.array(keys, pa.binary()),
                    "bands": pa.array(band, pa.list_(pa.int64())),
                    "registers": pa.array(register, pa.binary()),
                }
            )

    return docs.mapInArrow(sketch, "doc_id long, n_shingles long, set_key binary, bands array<long>, registers binary")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n, items``: the sets themselves."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BATCH_BYTES):
            values, sizes = shingle_sets(batch.column("text"), words)
            items = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values.view(np.int64)))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n": pa.array(sizes, pa.int64()), "items": items})

    return docs.mapInArrow(expand, "doc_id long, n long, items array<long>")


def likely(pairs: DataFrame, nodes: DataFrame, least: float, count: int) -> DataFrame:
    """The pairs whose estimated similarity does not lie clearly below ``least``."""
    chance = by_chance()
    floor = least - MARGIN * math.sqrt(least * (1 - least) / count)
    side = lambda name: nodes.select(F.col("doc_id").alias(name), F.col("registers").alias(f"of_{name}"))

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            grid = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, count)
                for c in ("of_a", "of_b")
            ]
            equal = (grid[0] == grid[1]).mean(axis=1)
            near = (equal - chance) / (1 - chance) >= floor
            yield batch.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "of_a", "of_b").mapInArrow(estimate, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, similar: int, of: int) -> DataFrame:
    """The pairs with ``of * intersection >= similar * union`` of their full sets."""
    side = lambda name: sets.select(F.col("doc_id").alias(name), F.col("n").alias(f"n_{name}"), F.col("items").alias(f"of_{name}"))
    shared = F.size(F.array_intersect("of_a", "of_b")).cast("long")
    both = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("shared", shared)
    return both.where(F.col("shared") * of >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * similar).select("a", "b")


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    similar: int = 80,
    of: int = 100,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered; documents are linked when
    ``of * intersection >= similar * union`` of their sets of ``words``-word shingles (the whole
    sequence, if shorter). ``component_id`` is the smallest id reachable over links; ``kept`` marks
    the row that has it. Without words or text a set is empty and the row stands alone. A null id
    links with nothing and gives null in both. Rows sharing an id are one node. Other
    columns are ignored. Sets hold 64-bit hashes of shingles: two different shingles count as one with a chance of about
    the square of their number over 2**65. With the default bands a pair at the threshold 0.85 is missed with a
    chance below 3e-7, at 0.8 below 6e-5, and a component only if all its links on a path are.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    used: list[str] = []
    rows_of = stored(sketches(docs, words, bands, rows), "sketches", used)
    known = rows_of.where("set_key is not null and doc_id is not null")
    heads = known.groupBy("set_key").agg(F.min("doc_id").alias("head"))
    nodes = known.join(heads, (known["set_key"] == heads["set_key"]) & (known["doc_id"] == heads["head"])).select("doc_id", "bands", "registers")
    nodes = stored(nodes, "nodes", used)
    places = nodes.select("doc_id", F.explode("bands").alias("bucket"))
    hubs = places.groupBy("bucket").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).where("a < last").select("bucket", "a")
    crowded = stored(places.join(hubs, "bucket"), "buckets", used)
    pairs = crowded.where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()
    wanted = crowded.select("doc_id").distinct()
    sets = stored(full_sets(docs.where("doc_id is not null").join(wanted, "doc_id", "left_semi"), words), "sets", used)
    least, count = similar / of, bands * rows
    links = confirmed(likely(pairs, nodes, least, count), sets, similar, of)
    found = components(links, used)

    def label(df: DataFrame, found: DataFrame) -> DataFrame:
        return df.join(found, df["doc_id"] == found["node"], "left").select(*df.columns, F.coalesce("component", "doc_id").alias("label"))

    # Buckets that still hold several components.
    labelled = label(crowded.select("doc_id", "bucket"), found)
    open_ = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket")
    open_ids = stored(labelled.join(open_, "bucket", "left_semi").select("doc_id", "label").distinct(), "open", used)
    rare = stored(rarest(sets.join(open_ids, "doc_id"), similar, of), "rare", used)
    # The most typical set of an item, which has the fewest shingles of its own, links with most others.
    hub = F.min_by(F.struct("doc_id", "label", "n", "room"), F.struct("single", "doc_id"))
    first = rare.groupBy("item").agg(hub.alias("h"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    x, y = first.select("item", "h.*").alias("x"), rare.alias("y")
    tried = x.join(y, across("<>", similar, of)).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    more = confirmed(likely(tried, nodes, least, count), sets, similar, of)
    edges = stored(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), "edges", used)
    found = components(edges, used)
    rare = label(rare.drop("label"), found)
    x, y = rare.alias("x"), rare.alias("y")
    left = x.join(y, across("<", similar, of)).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    more = confirmed(likely(left, nodes, least, count), sets, similar, of)
    found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), used)
    final = heads.join(found, heads["head"] == found["node"], "left").select("set_key", F.coalesce("component", "head").alias("component_id"))
    out = rows_of.select("doc_id", "n_shingles", "set_key").join(final, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    # Four numbers a document stay; the tables on the way are removed.
    out = stored(out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")), "near-duplicates")
    dropped(docs.sparkSession, used)
    return out


def across(labels: str, similar: int, of: int):
    """Pairs of rows of ``rarest`` in different components that can still be similar enough.

    From their first common shingle on, no more than ``room`` shingles of either can be common.
    """
    enough = f"least(x.room, y.room) * {of + similar} >= (x.n + y.n) * {similar}"
    return F.expr(f"x.item = y.item and x.label {labels} y.label and {enough}")


def rarest(sets: DataFrame, similar: int, of: int) -> DataFrame:
    """``doc_id, label, n, single, room, item``: the shingles of each set that similar sets cannot all lack.

    ``single`` counts those that no other set has; they come first and find nothing. ``room``
    counts the shingles from this one to the most frequent.
    """
    items = sets.select("doc_id", "label", "n", F.explode("items").alias("item"))
    often = items.groupBy("item").agg(F.count("*").alias("often")).where("often > 1")
    lists = (
        items.join(often, "item")
        .groupBy("doc_id", "label", "n")
        .agg(F.sort_array(F.collect_list(F.struct("often", "item"))).alias("shared"))
        .withColumn("single", F.col("n") - F.size("shared"))
    )
    place = F.col("n") - F.expr(f"(n * {similar} + {of - 1}) div {of}") + 1 - F.col("single")
    chosen = F.posexplode(F.slice("shared", F.lit(1), place.cast("int"))).alias("k", "s")
    rows = lists.where(place > 0).select("doc_id", "label", "n", "single", chosen)
    return rows.select("doc_id", "label", "n", "single", (F.col("n") - F.col("single") - F.col("k")).alias("room"), F.col("s.item").alias("item"))
