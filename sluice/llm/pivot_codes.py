"""Compression of vectors to one code per part, with exact integer codebooks and LAESA pruning.

Vectors become integers and are cut into equal parts. The distances of every part to a few fixed pivots are computed
once and stored with it. In each round the distances of the codebook's entries to the pivots are enough for a
lower bound of each distance from part to entry: the largest difference of their distances to a pivot. Entries are
tried in the order of that bound; those whose bound lies above the smallest distance found so far are
never compared. What is compared is compared in whole numbers, so ties and sums are exact.

Only sums and counts per entry leave a task; the driver holds the codebooks, nothing that grows with the rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import stored

SCALE, PARTS, ENTRIES, ROUNDS, PIVOTS = 1024, 4, 256, 4, 8
# How many entries are tried for a part before the bound is looked at again.
WAVES = (1, 3, 12, 48)
# Components lie below this over the root of the part's length, so the squared distances of four parts fit a long.
REACH = 1 << 29
BLOCK = 2048


def limit_of(width: int) -> int:
    """The largest component (as an integer) that a vector whose parts have ``width`` components may have."""
    return int(REACH / math.sqrt(max(width, 1)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``a`` to those of ``b``, exact."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1)


def nearest_entries(parts: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of each part's nearest entry, the lower index on ties; ``to_pivots`` has the parts' distances to the pivots."""
    count = len(parts)
    best, distance = np.zeros(count, np.int64), np.full(count, np.iinfo(np.int64).max)
    between = np.sqrt(distances(entries, pivots).astype(np.float64))
    for begin in range(0, count, BLOCK):
        rows = slice(begin, begin + BLOCK)
        low = np.zeros((len(parts[rows]), len(entries)))
        for p in range(len(pivots)):
            np.maximum(low, np.abs(to_pivots[rows, p : p + 1] - between[:, p]), out=low)
        # Roots are rounded; a bound a little lower excludes nothing that it must not.
        low = low * (1 - 1e-9) - 1e-6
        order = np.argsort(low, axis=1)
        active, done = np.arange(len(low)), 0
        own, found = best[rows], distance[rows]
        for wave in (*WAVES, len(entries)):
            if done >= len(entries) or not len(active):
                break
            tried = order[active, done : done + wave]
            done += wave
            # Bounds ascend along the tries; a part stops at the first one above its distance.
            near = low[active[:, None], tried] <= np.sqrt(found[active].astype(np.float64))[:, None]
            who, place = np.nonzero(near)
            row, entry = active[who], tried[who, place]
            exact = ((parts[begin + row] - entries[entry]) ** 2).sum(axis=1)
            by = np.lexsort((entry, exact, row))
            by = by[np.diff(row[by], prepend=-1) != 0]
            row, entry, exact = row[by], entry[by], exact[by]
            better = (exact < found[row]) | ((exact == found[row]) & (entry < own[row]))
            found[row[better]], own[row[better]] = exact[better], entry[better]
            active = active[near[:, -1]]
    return best, distance


def integers(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``vec_id, label, x`` of the rows whose vector is complete and finite, ``x`` the floors as longs, null where one does not fit a long."""
    kept = F.col(vector).isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda c: c * SCALE)
    fits = F.forall(scaled, lambda c: F.abs(c) < float(1 << 53))
    floors = F.when(fits, F.transform(scaled, lambda c: F.floor(c)))
    return rows.where(kept).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), floors.alias("x"))


class Coder:
    """Codebooks (parts x entries x components) and pivots of one table."""

    def __init__(self, entries: np.ndarray, pivots: np.ndarray):
        self.entries, self.pivots = entries, pivots
        self.parts, _, self.width = entries.shape

    def split(self, lists: pa.Array) -> np.ndarray:
        return np.asarray(lists.flatten(), dtype=np.int64).reshape(len(lists), self.parts, self.width)

    def assign(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The parts, and per row and part the nearest entry and its squared distance."""
        x = self.split(batch.column("x"))
        far = np.asarray(batch.column("to_pivots").flatten(), np.float64).reshape(len(x), self.parts, -1)
        each = [nearest_entries(x[:, p], far[:, p], self.entries[p], self.pivots[p]) for p in range(self.parts)]
        return x, np.stack([e[0] for e in each], axis=1), np.stack([e[1] for e in each], axis=1)


def with_pivot_distances(whole: DataFrame, coder: Coder) -> DataFrame:
    """The rows with ``to_pivots``: the distance of each part to each pivot of its position."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = coder.split(batch.column("x"))
            far = np.stack([np.sqrt(distances(x[:, p], coder.pivots[p]).astype(np.float64)) for p in range(coder.parts)], axis=1)
            ends = np.arange(0, far.size + 1, far[0].size) if len(x) else np.zeros(1, np.int64)
            yield batch.append_column("to_pivots", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(far.ravel())))

    return whole.mapInArrow(work, ", ".join([*(f"{c} {t}" for c, t in whole.dtypes), "to_pivots array<double>"]))


def entry_sums(rows: DataFrame, coder: Coder) -> DataFrame:
    """``part, entry, place, total, members`` over all rows, summed in each task first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = coder.entries.shape[1]
        totals = np.zeros((coder.parts, count, coder.width), np.int64)
        members = np.zeros((coder.parts, count), np.int64)
        for batch in batches:
            x, entry, _ = coder.assign(batch)
            if not len(x):
                continue
            for p in range(coder.parts):
                order = np.argsort(entry[:, p], kind="stable")
                own = entry[order, p]
                begins = np.flatnonzero(np.diff(own, prepend=-1))
                totals[p, own[begins]] += np.add.reduceat(x[order, p], begins)
                members[p] += np.bincount(own, minlength=count)
        part, entry = np.nonzero(members)
        places = np.arange(coder.width)
        yield pa.record_batch(
            {
                "part": np.repeat(part, coder.width).astype(np.int32),
                "entry": np.repeat(entry, coder.width).astype(np.int32),
                "place": np.tile(places, len(part)).astype(np.int32),
                "total": totals[part, entry].ravel(),
                "members": np.repeat(members[part, entry], coder.width),
            }
        )

    sums = rows.select("x", "to_pivots").mapInArrow(work, "part int, entry int, place int, total long, members long")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    return sums.groupBy("part", "entry", "place").agg(exact, F.sum("members").alias("members"))


def coded_rows(rows: DataFrame, coder: Coder) -> DataFrame:
    """``vec_id, label, code, error`` by the codebooks as they are."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, entry, distance = coder.assign(batch)
            digits = max(2, len(f"{coder.entries.shape[1] - 1:x}"))
            code = ["".join(f"{e:0{digits}x}" for e in row) for row in entry.tolist()]
            yield batch.select(["vec_id", "label"]).append_column("code", pa.array(code, pa.string())).append_column("error", pa.array(distance.sum(axis=1)))

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(work, f"vec_id long, label {kinds['label']}, code string, error long")


def first_vectors(usable: DataFrame, count: int) -> np.ndarray:
    """The vectors of the smallest ids, in their order; a bounded number of rows."""
    return np.array([r["x"] for r in usable.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(count).collect()], np.int64)


def with_label_errors(rows: DataFrame, salts: int = 64, few: int = 10_000) -> DataFrame:
    """``label_error``: the sum of ``error`` over all rows of a label, nulls being a label too; null if it fits no long.

    The sums are made in each task first. A label may hold a third of the rows, so rows do not meet by label alone:
    up to ``few`` labels are sent to the tasks, and more are copied once for each of ``salts`` shares of the rows.
    """
    sums = stored(rows.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "label-errors")
    if sums.limit(few + 1).count() <= few:
        return rows.join(F.broadcast(sums), rows["label"].eqNullSafe(sums["of"]), "left").drop("of")
    copies = sums.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    same = dealt["label"].eqNullSafe(copies["of"]) & (dealt["salt"] == copies["share"])
    return dealt.join(copies, same, "left").drop("of", "share", "salt")


def codebook_digest(entries: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, entries.ravel().tolist())).encode()).hexdigest()


def learn(usable: DataFrame, parts: int, entries: int, rounds: int, pivots: int) -> tuple[DataFrame, Coder] | None:
    """The stored rows with their pivot distances, and the codebooks after all rounds; None without rows."""
    first = first_vectors(usable, entries)
    if not len(first):
        return None
    books = first.reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    # The pivots stay: vectors of the first codebook, evenly chosen.
    chosen = np.unique(np.linspace(0, len(first) - 1, min(pivots, len(first))).astype(int))
    coder = Coder(books, books[:, chosen].copy())
    ready = stored(with_pivot_distances(usable, coder), "pivot-distances")
    for _ in range(rounds):
        books = coder.entries.copy()
        for r in entry_sums(ready, coder).collect():  # at most parts x entries x components rows
            books[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["members"]
        coder = Coder(books, coder.pivots)
    return ready, coder


def compress(
    rows: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error, label_error`` per row, and the codebooks (parts x entries x components).

    A component x counts as ``floor(1024 * x)``. The codebook of a part position starts as that part of the vectors with
    the smallest ids (rows that share an id by their integers, null ids last). In each round all parts go to their nearest entries by
    squared Euclidean distance, the lower index on ties, and each entry that has parts becomes the floor of their mean. ``code``
    has the index of the nearest final entry per part, two hex digits or more each; ``error`` is the sum of the distances.

    Rows whose vector is null, or holds a null or non-finite component, are left out. All vectors have the length of
    the one with the smallest id whose length is a positive multiple of ``parts``. Vectors of other lengths, and those with a
    component too large for exact distances in a long (beyond 2**29 over the root of a part's length, as an integer), take no
    part in the codebooks and have a null ``code`` and ``error``. Rows with null or repeated ids have rows of their own.
    ``label_error`` sums the errors of equal labels, null labels together. Other columns are ignored; an empty table gives
    no rows and empty codebooks.
    """
    whole = integers(rows, vec_id, vector, label)
    sized = whole.where((F.size("x") > 0) & (F.size("x") % parts == 0))
    head = sized.orderBy(F.col("vec_id").asc_nulls_last(), "x").select(F.size("x").alias("n")).first()
    size = head["n"] if head else 0
    reach = F.lit(limit_of(size // parts))
    fits = F.coalesce((F.size("x") == size) & F.forall("x", lambda c: F.abs(c) <= reach), F.lit(False)) if size else F.lit(False)
    made = learn(whole.where(fits), parts, entries, rounds, pivots)
    nothing = F.lit(None)
    others = whole.where(~fits).select("vec_id", "label", nothing.cast("string").alias("code"), nothing.cast("long").alias("error"))
    if made is None:
        return others.withColumn("label_error", nothing.cast("long")), np.zeros((parts, 0, 0), np.int64)
    ready, coder = made
    out = stored(coded_rows(ready, coder), "codes").unionByName(others)
    return with_label_errors(out), coder.entries
