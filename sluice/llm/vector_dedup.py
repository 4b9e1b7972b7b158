"""Near-duplicate vectors: p-stable hashing of unit vectors, confirmed by their cosines.

Equal vectors are one node from the start. The others are hashed into several tables; a bucket is
compared block against block inside of tasks, so a large bucket spreads over many of them
and no pair leaves a task: only counts and the edges of a spanning forest do.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.components import components, stored
from sluice.llm.vectors import PStable, matrices, meeting, unit, usable

WIDTH = 2.5
# Unrelated vectors that share a bucket with a given one in one table, and the chance to miss a pair at the threshold.
CROWD, MISS = 300, 1e-4
BLOCK = 1024


def design(count: int, cosine: float, miss: float = MISS) -> PStable:
    """More vectors need more projections, and these more tables, for the same chance to miss a pair."""
    far, near = meeting(math.sqrt(2), WIDTH), meeting(math.sqrt(2 - 2 * cosine), WIDTH)
    projections = max(4, math.ceil(math.log(max(count, 1) / CROWD) / -math.log(far)))
    return PStable(math.ceil(math.log(miss) / math.log(1 - near**projections)), projections, WIDTH)


def hashed(heads: DataFrame, hashing: PStable) -> DataFrame:
    """``head, copies, vector, keys`` with a key per table."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros((batch.num_rows, hashing.tables), np.int64)
            for rows, m in matrices(batch.column("vector")):
                keys[rows] = hashing.keys(np.floor(hashing.places(unit(m))), m.shape[1])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, hashing.tables), pa.int32()), pa.array(keys.ravel()))
            yield batch.append_column("keys", lists)

    return heads.mapInArrow(work, "head long, copies long, vector array<double>, keys array<long>")


def compared(blocks: DataFrame, cosine: float) -> DataFrame:
    """``head, links, low``: links counted in the first table that shows them, and the smallest id linked here."""

    def pairs(table: int, a: dict, b: dict | None) -> Iterator[tuple]:
        other = b or a
        near = unit(a["m"]) @ unit(other["m"]).T >= cosine
        if b is None:
            near &= np.tri(len(near), k=-1, dtype=bool)
        x, y = np.nonzero(near)
        if not len(x):
            return
        new = ~(a["keys"][x, :table] == other["keys"][y, :table]).any(axis=1)
        heads = a["head"] if b is None else np.concatenate([a["head"], b["head"]])
        copies = a["copies"] if b is None else np.concatenate([a["copies"], b["copies"]])
        y = y if b is None else y + len(a["head"])
        links = np.bincount(x[new], copies[y[new]], len(heads)) + np.bincount(y[new], copies[x[new]], len(heads))
        low = heads.copy()
        while True:  # the smallest id of each connected group in this block
            before = low.copy()
            np.minimum.at(low, x, low[y])
            np.minimum.at(low, y, low[x])
            if (low == before).all():
                break
        told = np.flatnonzero((links > 0) | (low < heads))
        yield heads[told], links[told].astype(np.int64), low[told]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        for (table, _, lo, hi), group in itertools.groupby(rows, key=lambda r: r[:4]):
            sides: dict[int, list] = {lo: [], hi: []}
            for r in group:
                sides[r[4]].append(r)
            if not all(sides.values()):
                continue
            ready = {
                s: {
                    "head": np.array([r[5] for r in members], np.int64),
                    "copies": np.array([r[6] for r in members], np.int64),
                    "m": np.array([r[7] for r in members], np.float64),
                    "keys": np.array([r[8] for r in members], np.int64),
                }
                for s, members in sides.items()
            }
            for heads, links, low in pairs(table, ready[lo], None if lo == hi else ready[hi]):
                yield pa.record_batch({"head": pa.array(heads), "links": pa.array(links), "low": pa.array(low)})

    return blocks.mapInArrow(work, "head long, links long, low long")


def near_duplicates(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, block: int = BLOCK) -> DataFrame:
    """One row per row: ``vec_id, n_links, component_id, kept``.

    Rows are linked when the cosine of their vectors, in double precision, is at least ``cosine``; equal
    vectors always are. ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest
    id reachable, and ``kept`` marks the row that has it. Vectors that are null, zero, or hold a null
    or non-finite component link with nothing, as do vectors of different lengths with each other. Rows with a null id
    link with nothing and have neither component nor mark. Rows that share an id are one node, with the links of
    all its vectors. Other columns are ignored.
    """
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    heads = rows.where(usable("vector") & F.col("vec_id").isNotNull()).groupBy("vector").agg(F.min("vec_id").alias("head"), F.count("*").alias("copies"))
    heads = stored(heads.select("head", "copies", "vector"), "vectors")
    hashing = design(heads.count(), cosine)
    placed = hashed(heads, hashing).select("head", "copies", "vector", "keys", F.posexplode("keys").alias("table", "bucket"))
    # Counted on the keys alone.
    counts = placed.groupBy("table", "bucket").count().where("count > 1")
    sized = placed.join(counts, ["table", "bucket"]).withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    own = F.pmod(F.xxhash64("head"), F.col("blocks")).cast("int")
    spread = sized.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = spread.select(
        "table", "bucket", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "head", "copies", "vector", "keys"
    )
    groups = ["table", "bucket", "lo", "hi"]
    found = stored(compared(blocks.repartition(*groups).sortWithinPartitions(*groups), cosine), "links")
    linked = found.groupBy("head").agg(F.sum("links").alias("links"))
    reach = components(found.where("low <> head").select(F.col("head").alias("a"), F.col("low").alias("b")))
    nodes = (
        heads.join(linked, "head", "left")
        .join(reach, heads["head"] == reach["node"], "left")
        .select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "head").alias("component"))
    )
    # Null ids and unusable vectors find no partner.
    key = F.when(usable("vector") & F.col("vec_id").isNotNull(), F.col("vector"))
    out = rows.withColumn("key", key).join(nodes.withColumnRenamed("vector", "key"), "key", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept")
    )
