"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Every vector lies in one bucket per table. A query visits its own bucket and those around it, changed
in one or more projections, in the order of their estimated success: the sum of the squared distances
to the borders that are crossed. The rows are dealt out once, each to one task with its buckets of all tables, and every query
meets every task's rows: a task looks the query's buckets up among its own, ranks what lies in them exactly and lets out
the best rows only. The few queries that find less than they are owed are compared with all rows in the same way.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from sluice.llm.components import stored
from sluice.llm.vectors import PStable, cosines, matrices, unit, usable
from sluice.llm.words import mixed, released

# Measured at these: see the README.
TABLES, PROJECTIONS, WIDTH, PROBES = 8, 10, 2.5, 128
BLOCK = 4096
# Components that one task holds, and those it gets at least where there are more tasks than work.
HELD, LEAST = 1 << 24, 1 << 18
# Queries that meet the rows of a task at once, those whose buckets are listed at once, and the bytes of their marks on the task's buckets.
QUERIES, LISTED, MARKS = 256, 64, 1 << 25
# A query whose buckets hold less than this part of a task's rows is compared with these rows alone.
SELECTIVE = 16


def smallest(scores: np.ndarray, most: int) -> np.ndarray:
    """Per row the places of the ``most`` smallest scores, in no order."""
    rows, width = scores.shape
    if width <= most:
        return np.arange(width)[None].repeat(rows, axis=0)
    at = np.flatnonzero(scores <= np.partition(scores, most - 1, axis=1)[:, most - 1 : most])
    if len(at) > rows * most:  # ties
        return np.argpartition(scores, most - 1, axis=1)[:, :most]
    return at.reshape(rows, most) % width


def likeliest(fraction: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the scores and codes of up to ``most`` sets of steps, the likeliest ones, in no order; for up to 39 projections.

    A code has a digit to base 3 per projection: stay, step down, step up. The sets are put together from those of both
    halves of the projections: the sum of the i-th and the j-th best is one of i times j that are no worse.
    """
    projections = fraction.shape[1]
    if projections == 1:
        scores, codes = np.hstack([np.zeros_like(fraction), fraction**2, (1 - fraction) ** 2]), np.arange(3, dtype=np.int32)[None].repeat(len(fraction), axis=0)
        best = smallest(scores, most)
        return np.take_along_axis(scores, best, axis=1), np.take_along_axis(codes, best, axis=1)
    half, kind = projections // 2, np.int32 if projections < 20 else np.int64
    sides = []
    for part in (fraction[:, :half], fraction[:, half:]):
        scores, codes = likeliest(part, most)
        order = np.argsort(scores, axis=1)
        sides.append((np.take_along_axis(scores, order, axis=1), np.take_along_axis(codes, order, axis=1).astype(kind)))
    (low, low_codes), (high, high_codes) = sides
    i, j = np.nonzero(np.outer(np.arange(1, low.shape[1] + 1), np.arange(1, high.shape[1] + 1)) <= most)
    scores = np.take(low, i, axis=1) + np.take(high, j, axis=1)
    best = smallest(scores, most)
    codes = np.take_along_axis(low_codes, i[best], axis=1) + kind(3**half) * np.take_along_axis(high_codes, j[best], axis=1)
    return np.take_along_axis(scores, best, axis=1), codes


def steps(codes: np.ndarray, projection: int) -> np.ndarray:
    """The codes' steps (-1, 0 or 1) in one projection."""
    return np.array([0, -1, 1], np.int8)[codes // 3**projection % 3]


def perturbations(fraction: np.ndarray, most: int) -> list[list[tuple[int, int]]]:
    """Up to ``most`` sets of (projection, step), likeliest first; the empty set comes first."""
    scores, codes = likeliest(np.asarray(fraction)[None], most)
    moved = np.array([steps(codes[0], p) for p in range(len(fraction))]).T
    order = np.lexsort((np.count_nonzero(moved, axis=1), scores[0]))
    return [[(p, step) for p, step in enumerate(row) if step] for row in moved[order].tolist()]


def first_of_each(groups: np.ndarray, most: int) -> np.ndarray:
    """Which places of a sorted array are among the first ``most`` of their value."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups) < most


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...``, as many as ``count`` has, one range after the other."""
    return np.repeat(start - (np.cumsum(count) - count), count) + np.arange(count.sum())


def digests(m: np.ndarray) -> np.ndarray:
    """A 64-bit number per row, the same for equal ones."""
    words = m.view(np.uint32 if m.dtype == np.float32 else np.uint64).astype(np.uint64)
    return mixed((mixed(words + np.arange(1, m.shape[1] + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)).sum(axis=1))


def marked(chosen: np.ndarray, size: int) -> np.ndarray:
    """The places of the few true values among the first ``size``, looked for eight at a time."""
    places = np.flatnonzero(chosen[: -(-size // 8) * 8].view(np.uint64) != 0)[:, None] * 8 + np.arange(8)
    return places[chosen[places] & (places < size)]


class Shelf:
    """The rows of one length that a task holds: distinct vectors, their smallest ids, and their buckets in each table.

    Without ``hashing`` all of them are candidates of every query.
    """

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray]], hashing: PStable | None, k: int, probes: int, block: int):
        """``parts`` are pairs of ids and vectors; they are taken out of the list."""
        self.hashing, self.k, self.probes, self.block = hashing, k, probes, block
        # Of the k + 1 best vectors one may be the query's own row; of equal ones the k + 1 smallest ids are enough.
        self.most = k + 1
        ids, m = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        m += m.dtype.type(0)  # no negative zeros
        digest = np.concatenate([digests(m[n : n + 8192]) for n in range(0, len(m), 8192)])
        order = np.lexsort((ids, digest))
        self.ids, m, digest = ids[order], m[order], digest[order]
        again = np.flatnonzero(digest[1:] == digest[:-1]) + 1
        first = np.ones(len(m), bool)
        first[again] = np.concatenate([(m[n] != m[n - 1]).any(axis=1) for n in np.array_split(again, 1 + len(again) // 8192)])
        self.start = np.flatnonzero(first)
        self.count = np.minimum(np.diff(np.append(self.start, len(m))), self.most)
        self.m = m if first.all() else m[first]
        del m
        self.units = np.empty(self.m.shape, np.float32)
        # Rounded to 24 bits, a scalar product of unit vectors is off by less than half of this.
        self.slack = (self.m.shape[1] + 8) * 2.0**-22
        keys = np.empty((hashing.tables if hashing else 0, len(self.m)), np.int64)
        for n in range(0, len(self.m), 8192):
            u = unit(self.m[n : n + 8192].astype(np.float64))
            self.units[n : n + 8192] = u
            if hashing:
                keys[:, n : n + 8192] = hashing.keys(np.floor(hashing.places(u)), self.m.shape[1]).T
        self.tables = []
        for key in keys:
            names, bucket, sizes = np.unique(key, return_inverse=True, return_counts=True)
            members = np.argsort(bucket, kind="stable").astype(np.int32)
            self.tables.append((names, bucket.astype(np.int32), np.cumsum(sizes) - sizes, sizes, members))
        self.at_once = max(1, min(QUERIES, MARKS // max(1, sum(len(t[0]) for t in self.tables))))

    def best(self, asking: np.ndarray, q: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``query_id, vec_id, score`` of the ``k`` best candidates of each query."""
        for n in range(0, len(q), self.at_once):
            names, v = asking[n : n + self.at_once], q[n : n + self.at_once]
            asks, rows, score = self.nearest(v, unit(v))
            copies = self.count[rows]
            who, score = np.repeat(asks, copies), np.repeat(score, copies)
            ids = self.ids[ranges(self.start[rows], copies)]
            order = np.lexsort((ids, -score, who))
            order = order[ids[order] != names[who[order]]]
            order = order[first_of_each(who[order], self.k)]
            yield pa.record_batch({"query_id": pa.array(names[who[order]]), "vec_id": pa.array(ids[order]), "score": pa.array(score[order])})

    def nearest(self, q: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of the best candidates, as places in both."""
        if not self.hashing:
            return self.compared(q, u.astype(np.float32), [])
        visited = [np.concatenate(x) for x in zip(*(self.visited(u[n : n + LISTED]) for n in range(0, len(u), LISTED)))]
        reach = sum(np.where(at < 0, 0, table[3][at]).sum(axis=1) for table, at in zip(self.tables, visited))
        many = np.flatnonzero(reach * SELECTIVE >= len(self.m))
        marks = []
        for table, at in zip(self.tables, visited):
            mark = np.zeros((len(many), len(table[0]) + 1), bool)
            mark[np.arange(len(many))[:, None], at[many]] = True  # what is not there falls into the last column
            marks.append(mark)
        asks, rows, score = self.compared(q[many], u[many].astype(np.float32), marks)
        few = self.looked_up(q, u.astype(np.float32), np.flatnonzero((reach > 0) & (reach * SELECTIVE < len(self.m))), visited)
        return tuple(np.concatenate(x) for x in zip((many[asks], rows, score), few))

    def visited(self, u: np.ndarray) -> list[np.ndarray]:
        """Per table the places of each query's buckets among those there are; -1 for one that is not there."""
        h, size = self.hashing, u.shape[1]
        places = h.places(u)
        cells = np.floor(places)
        codes = likeliest((places - cells).reshape(-1, h.projections), self.probes)[1]
        codes = np.ascontiguousarray(codes.reshape(len(u), h.tables, -1).transpose(0, 2, 1))
        moved = np.array([cells[:, None, :, p] + steps(codes, p) for p in range(h.projections)])  # projection, query, set, table
        keys = h.keys(moved.reshape(h.projections, -1, h.tables).transpose(1, 2, 0), size).reshape(codes.shape)
        out = []
        for t, (names, *_) in enumerate(self.tables):
            at = np.minimum(np.searchsorted(names, keys[:, :, t]), len(names) - 1)
            out.append(np.where(names[at] == keys[:, :, t], at, -1))
        return out

    def compared(self, q: np.ndarray, u: np.ndarray, marks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All rows, block by block: what may be among the best and lies in a marked bucket is ranked exactly."""
        kept = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        room, chosen = np.empty(len(u) * self.block, np.float32), np.zeros(len(u) * self.block + 8, bool)
        bound = np.full(len(u), -1.5, np.float32)
        # The first block is a small one, as all of its candidates are found.
        for begin, end in itertools.pairwise(sorted({0, *range(max(1, self.block // 4), len(self.m), self.block), len(self.m)})) if len(u) else ():
            near = np.matmul(u, self.units[begin:end].T, out=room[: len(u) * (end - begin)].reshape(len(u), -1))
            if not begin:
                if marks:
                    near[~np.logical_or.reduce([mark[:, table[1][:end]] for mark, table in zip(marks, self.tables)])] = -2
                if end > self.most:
                    bound = np.maximum(bound, np.partition(near, end - self.most, axis=1)[:, end - self.most] - np.float32(self.slack))
            np.greater_equal(near, bound[:, None], out=chosen[: near.size].reshape(near.shape))
            asks, rows = np.divmod(marked(chosen, near.size), end - begin)
            rows += begin
            if marks and begin:
                met = np.logical_or.reduce([mark[asks, table[1][rows]] for mark, table in zip(marks, self.tables)])
                asks, rows = asks[met], rows[met]
            if not len(asks):
                continue
            score = self.exact(q, asks, rows)
            kept = self.top(*(np.concatenate(x) for x in zip(kept, (asks, rows, score))))
            full = np.flatnonzero(np.bincount(kept[0], minlength=len(u)) == self.most)
            bound[full] = kept[2][np.searchsorted(kept[0], full, "right") - 1] - self.slack
        return kept

    def looked_up(self, q: np.ndarray, u: np.ndarray, few: np.ndarray, visited: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each of ``few`` queries the members of its buckets only."""
        asks, rows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in few.tolist():
            met = []
            for (_, _, start, sizes, members), at in zip(self.tables, visited):
                there = at[n][at[n] >= 0]
                met.append(members[ranges(start[there], sizes[there])])
            found = np.unique(np.concatenate(met)).astype(np.int64)
            near = self.units[found] @ u[n]
            if len(found) > self.most:
                found = found[near >= np.partition(near, len(found) - self.most)[len(found) - self.most] - self.slack]
            asks.append(np.full(len(found), n))
            rows.append(found)
        who, which = np.concatenate(asks), np.concatenate(rows)
        return self.top(who, which, self.exact(q, who, which))

    def exact(self, q: np.ndarray, asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = np.empty(len(asks))
        for n in range(0, len(asks), BLOCK):
            part = slice(n, n + BLOCK)
            out[part] = cosines(q[asks[part]], self.m[rows[part]].astype(np.float64))
        return out

    def top(self, asks: np.ndarray, rows: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best rows of each query in their order; ties go to the smaller id."""
        order = np.lexsort((self.ids[self.start[rows]], -score, asks))
        order = order[first_of_each(asks[order], self.most)]
        return asks[order], rows[order], score[order]


def search(
    rows: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    hashing: PStable | None = None,
    probes: int = PROBES,
    block: int = BLOCK,
    held: int = HELD,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` for each of ``queries``: the ``k`` nearest of ``rows`` found.

    The score is the cosine in double precision; ties go to the smaller id. A query never finds its
    own id. Vectors that are null, zero, or hold a null or non-finite component take no part on
    either side, nor do null ids; vectors of different lengths do not meet. Of rows that share an id the
    one with the smallest vector counts. A query has ``k`` rows, or as many as there are candidates if these are fewer; those
    whose buckets hold less are compared with all rows. Other columns are ignored. Empty tables give no rows.

    A task holds about ``held`` components and compares ``block`` rows at once.
    """
    hashing = hashing or PStable(TABLES, PROJECTIONS, WIDTH)
    single = {df.select(F.col(vector)).schema[0].dataType.simpleString() for df in (rows, queries)} == {"array<float>"}
    kind = "array<float>" if single else "array<double>"
    side = lambda df: df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).cast(kind).alias("vector")).where(
        usable("vector") & F.col("id").isNotNull()
    )
    once = side(rows).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = stored(side(queries).groupBy("id").agg(F.min("vector").alias("vector")), "queries")
    total = rows.agg(F.coalesce(F.sum(F.greatest(F.size(F.col(vector)), F.lit(0)).cast("long")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // held), min(rows.sparkSession.sparkContext.defaultParallelism, total // LEAST))

    def ranked(asked: DataFrame, hashing: PStable | None) -> DataFrame:
        """``query_id, rank, vec_id, score`` of the best candidates."""

        def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, loose, shelves = None, {}, {}
            for batch in batches:
                place = np.asarray(batch.column("block")), np.asarray(batch.column("asks"))
                cuts = np.flatnonzero((np.diff(place[0]) != 0) | (np.diff(place[1]) != 0)) + 1
                for begin, end in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
                    if begin == end:
                        continue
                    if place[0][begin] != here:  # the rows of a block come before its queries
                        here, loose, shelves = place[0][begin], {}, {}
                    part = batch.slice(begin, end - begin)
                    ids = np.asarray(part.column("id"))
                    for at, m in matrices(part.column("vector")):
                        size = m.shape[1]
                        if not place[1][begin]:
                            # By a power of two, which changes no cosine but keeps squares from overflowing.
                            m = m.astype(np.float32) if single else np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1])
                            loose.setdefault(size, []).append((ids[at], m))
                            continue
                        if size in loose:
                            shelves[size] = Shelf(loose.pop(size), hashing, k, probes, block)
                        if size in shelves:
                            m = m if single else np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1])
                            yield from shelves[size].best(ids[at], m)
            released()

        rows_ = once.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("asks"), "id", "vector")
        asks = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("asks"), "id", "vector")
        met = (
            rows_.union(asks)
            .repartitionById(blocks, F.col("block"))
            .sortWithinPartitions("block", "asks")
            .mapInArrow(rank, "query_id long, vec_id long, score double")
        )
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    found = stored(ranked(asked, hashing), "neighbours")
    # Queries whose buckets hold too few rows are compared with all rows.
    enough = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"))
    short = stored(asked.join(enough, "id", "left_anti"), "short-queries")
    if not short.limit(1).count():
        return found
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(ranked(short, None))
