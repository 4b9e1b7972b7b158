"""Sizes, partition counts, broadcasts and caches."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MB = 1024 * 1024

# Cache levels by intent.
CACHE_LEVELS = {
    "memory": StorageLevel.MEMORY_ONLY,
    "memory_disk": StorageLevel.MEMORY_AND_DISK,
    "disk": StorageLevel.DISK_ONLY,
}


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate: file sizes for scans, upper bounds for joins. Runs no job."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_when_small(df: DataFrame, limit_bytes: int = 10 * MB) -> DataFrame:
    """Mark a join side for broadcast only when its estimated size is below the limit.

    Beyond it the side is returned as is, and Spark shuffles the join.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit_bytes else df


def partitions_for_size(size_mb: float, target_mb: float = 128) -> int:
    return max(int(size_mb / target_mb), 1)


def partitions_for_rows(row_count: int, per_partition: int = 500_000, most: int | None = None) -> int:
    wanted = max(1, row_count // per_partition)
    return wanted if most is None else min(wanted, most)


def fit_to_size(df: DataFrame, target_mb: float = 128) -> DataFrame:
    """Rebalance so a partition holds about ``target_mb`` of the estimated data. Runs no job.

    The rows are dealt evenly in one shuffle, and adaptive execution splits or merges what turns out otherwise.
    """
    return rebalanced(df, partitions_for_size(estimated_bytes(df) / MB, target_mb))


def fit_to_rows(df: DataFrame, per_partition: int = 500_000, most: int | None = None) -> DataFrame:
    """The same by the number of rows: the optimizer's, where it has one (as for analysed tables), else from the estimated bytes
    and the width of a row. Runs no job."""
    return rebalanced(df, partitions_for_rows(estimated_rows(df), per_partition, most))


def estimated_rows(df: DataFrame) -> int:
    """The optimizer's number of rows, or its bytes over the default width of a row of this schema."""
    known = df._jdf.queryExecution().optimizedPlan().stats().rowCount()
    if known.isDefined():
        return int(str(known.get()))
    return estimated_bytes(df) // max(1, df._jdf.schema().defaultSize())


def rebalanced(df: DataFrame, wanted: int) -> DataFrame:
    return df.hint("rebalance", wanted) if wanted > 1 else df.coalesce(1)


def output_files(df: DataFrame, target_mb: float = 256) -> int:
    return max(1, math.ceil(estimated_bytes(df) / MB / target_mb))


@contextmanager
def cached(df: DataFrame, level: str = "memory_disk") -> Iterator[DataFrame]:
    """Keep a DataFrame for the duration of a block; release it even when the block fails."""
    held = df.persist(CACHE_LEVELS[level])
    try:
        yield held
    finally:
        held.unpersist()
