"""Shared parts of the vector operators: which vectors count, and Euclidean p-stable hashing."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from sluice.llm.words import mixed


def usable(vector: str) -> Column:
    """Not null, not all zero, and every component a finite number."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and a matrix in double precision for each number of components that occurs."""
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=np.float64)
    begin = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, flat[begin[rows][:, None] + np.arange(size)]


def unit(m: np.ndarray) -> np.ndarray:
    # Scaled first, so squares neither overflow nor vanish.
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``a`` with the same row of ``b``; the result depends on the two rows alone."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


class PStable:
    """``tables`` times ``projections`` quantised Gaussian projections of unit vectors."""

    def __init__(self, tables: int, projections: int, width: float, seed: int = 0):
        self.tables, self.projections, self.width, self.seed = tables, projections, width, seed
        self.made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def places(self, units: np.ndarray) -> np.ndarray:
        """Where the vectors fall, in cells: rows x tables x projections."""
        size = units.shape[1]
        if size not in self.made:
            rng = np.random.default_rng([self.seed, size])
            self.made[size] = (rng.normal(size=(size, self.tables * self.projections)), rng.uniform(0, 1, self.tables * self.projections))
        a, b = self.made[size]
        return (units @ a / self.width + b).reshape(len(units), self.tables, self.projections)

    def keys(self, cells: np.ndarray, size: int) -> np.ndarray:
        """One number per table for the cells (rows x tables x projections) of vectors of ``size`` components."""
        h = np.zeros(cells.shape[:2], np.uint64) + np.arange(1, cells.shape[1] + 1, dtype=np.uint64) + np.uint64(size << 20)
        for p in range(self.projections):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + cells[:, :, p].astype(np.int64).view(np.uint64))
        return h.view(np.int64)


def meeting(distance: float, width: float) -> float:
    """How often two vectors at a distance fall into the same cell of one projection."""
    r = width / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))
