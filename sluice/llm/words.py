"""Splitting whole Arrow text columns into words, and cutting batches to a size in bytes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

# Text handled at once by one Python worker; a longer single text is handled alone.
CHUNK_BYTES = 4 << 20


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces whose texts take at most ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        begin, held = 0, 0
        for row, size in enumerate(sizes.tolist()):
            if row > begin and held + size > limit:
                yield batch.slice(begin, row - begin)
                begin, held = row, 0
            held += size
        yield batch.slice(begin)
    released()


def released() -> None:
    """Give memory that is no longer used back to the system: workers outlive their tasks, and the next stage needs it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only there with glibc
    if trim is not None:
        trim(0)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in order, and the number of words per text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, sizes = lists.flatten(), np.diff(np.asarray(lists.offsets, dtype=np.int64))
    filled = np.asarray(pc.greater(pc.binary_length(flat), 0))
    owner = np.repeat(np.arange(len(texts)), sizes)[filled]
    return flat.filter(pa.array(filled)), np.bincount(owner, minlength=len(texts)).astype(np.int64)


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """An exact integer code per word, and the distinct words in the order of their codes."""
    if not len(words):
        return np.zeros(0, np.int64), pa.array([], pa.large_string())
    encoded = words.dictionary_encode()
    return np.asarray(encoded.indices, dtype=np.int64), encoded.dictionary


def word_hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w, seed) for w in distinct.cast(pa.large_binary()).to_pylist()), np.uint64, len(distinct))


def mixed(h: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (the finishing step of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` consecutive values."""
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for step in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[step : step + count]
        out ^= out >> np.uint64(29)
    return mixed(out)
