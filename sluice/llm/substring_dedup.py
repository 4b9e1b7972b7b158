"""Removal of repeated passages: every word window that a smaller document has is cut.

Windows of consecutive words are grouped by super-k-mers. The minimiser of a window is the word
pair in it with the smallest hash; neighbouring windows mostly share it, so a run of them
travels as one packed string to the bucket of the minimiser, where the windows are sorted and
counted exactly. Before that each batch of documents settles its own repeats, so a passage that
stands in a third of all documents leaves a batch once only. Minimisers that stay frequent, at
the edges of such passages, are found by a counting pass over all documents; their windows travel
alone, by the hash of the whole window.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from sluice.llm.words import chunks, coded, mixed, run_hashes, split_words, word_hashes

WINDOW = 13
MINIMISER = 2
# A minimiser with this share of all super-k-mers counts as frequent, so there are at most as many as its inverse.
HOT_SHARE = 1e-4
# Words whose windows one bucket and one partition hold on average, and the fewest buckets.
BUCKET_WORDS, PARTITION_WORDS, FEWEST_BUCKETS = 500_000, 4_000_000, 512
# Text that is worked on together; it bounds the memory of a worker, and copies in it travel once.
BATCH_BYTES = 5 << 20
# Words of super-k-mers that a worker writes out at once; they hold the words of a batch about three times over.
PIECE_WORDS = 1 << 17

LEVEL = 6
LONG_WORD = 64

SPANS = "doc_id long, mark long, first long, last long"


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def grouped(codes: np.ndarray, hashes: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the windows that begin at ``at``: their order, and where in it a new window begins.

    ``hashes`` are the window hashes at those places. Neighbours of equal hash are compared word
    by word; should two different windows share a hash, exact ranks replace the hashes.
    """
    order = np.argsort(hashes, kind="stable")
    ordered, same = hashes[order], np.zeros(len(at), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    del ordered
    here = np.flatnonzero(same)
    place, before = at[order[here]], at[order[here - 1]]
    if any((codes[place + j] != codes[before + j]).any() for j in range(window)):
        ranks = np.zeros(len(at), np.int64)
        for j in range(window):
            _, ranks = np.unique(ranks * (int(codes.max()) + 1) + codes[at + j], return_inverse=True)
        order = np.argsort(ranks, kind="stable")
        same[1:] = ranks[order][1:] == ranks[order][:-1]
    return order, ~same


def block_hashes(distinct: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine, taken over eight bytes of all words at a time.

    Words above :data:`LONG_WORD` bytes are hashed one by one.
    """
    raw = distinct.cast(pa.large_binary())
    if not len(raw):
        return np.zeros(0, np.uint64)
    offsets = np.frombuffer(raw.buffers()[1], "<i8")[raw.offset : raw.offset + len(raw) + 1]
    size, begin = np.diff(offsets), offsets[:-1] - offsets[0]
    held = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    padded = np.append(held, np.zeros(8, np.uint8))
    eight = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    out = mixed(size.astype(np.uint64))
    for at in range(0, LONG_WORD, 8):
        rows = np.flatnonzero(size > at)
        if not len(rows):
            break
        missing = np.maximum(at + 8 - size[rows], 0).astype(np.uint64) * np.uint64(8)
        block = (eight[begin[rows] + at] << missing) >> missing
        out[rows] = mixed((out[rows] ^ block) + np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero(size > LONG_WORD)
    out[long] = word_hashes(raw.take(pa.array(long)))
    return out


def coded_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The code of each word, the distinct words, and the number of words per text; the words themselves are let go."""
    words, sizes = split_words(texts)
    codes, distinct = coded(words)
    return codes.astype(np.int32), distinct, sizes


def counted_up(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first, first + 1, ...``, ``count`` of them, for each pair."""
    out = np.repeat(first - (np.cumsum(count) - count), count)
    out += np.arange(len(out))
    return out


class Windows:
    """The windows of a list of texts, side by side in one array of words.

    ``at`` is the word a window begins with, ``owner`` its text and ``place`` the number of that word in the text.
    """

    def __init__(self, texts: pa.Array, window: int, part: int):
        self.codes, self.distinct, sizes = coded_words(texts)
        hashes = block_hashes(self.distinct)[self.codes]
        count = np.maximum(sizes - window + 1, 0)
        first = np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), count)
        self.at = counted_up(first, count)
        self.hash = run_hashes(hashes, window)[self.at]
        self.least = smallest(run_hashes(hashes, part), window - part + 1)[self.at]

    def place(self, chosen: np.ndarray) -> np.ndarray:
        """The number in its text of the word each of the chosen windows begins with."""
        begin = np.flatnonzero(np.diff(self.owner, prepend=-1))
        first = np.zeros(int(self.owner[-1]) + 1 if len(self.owner) else 0, np.int64)
        first[self.owner[begin]] = self.at[begin]
        return self.at[chosen] - first[self.owner[chosen]]


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of the values the ascending array has."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def later(w: Windows, ids: np.ndarray, window: int) -> np.ndarray:
    """Which windows also begin in a text of this batch with a smaller id."""
    order, new = grouped(w.codes, w.hash, w.at, window)
    begin = np.flatnonzero(new)
    doc = ids[w.owner[order]]
    late = np.empty(len(order), bool)
    late[order] = doc > np.repeat(np.minimum.reduceat(doc, begin), np.diff(np.append(begin, len(order))))
    return late


def super_kmers(w: Windows, late: np.ndarray, hot: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of windows that travel together, by bucket: bucket, first window, number of windows."""
    kept = np.flatnonzero(~late)
    least, owner = w.least[kept], w.owner[kept]
    alone = among(least, hot)
    run = np.ones(len(kept), bool)
    run[1:] = (least[1:] != least[:-1]) | (np.diff(w.at[kept]) != 1) | (owner[1:] != owner[:-1])
    run |= alone
    begin = np.flatnonzero(run)
    count = np.diff(np.append(begin, len(kept)))
    begin_at = kept[begin]
    route = np.where(alone[begin], w.hash[begin_at], mixed(w.least[begin_at]))
    bucket = (route % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return bucket[order], begin_at[order], count[order]


def joined_words(codes: np.ndarray, distinct: pa.Array, first: np.ndarray, size: np.ndarray, cuts: np.ndarray) -> Iterator[bytes]:
    """For the runs from each of ``cuts`` to the next the words of all of them, joined by one space."""
    words = np.cumsum(np.add.reduceat(size, cuts)) if len(cuts) else cuts
    ends, done = np.append(cuts, len(first)), 0
    while done < len(cuts):
        held = words[done - 1] if done else 0
        upto = max(done + 1, int(np.searchsorted(words, held + PIECE_WORDS, "right")))
        a, b = ends[done], ends[upto]
        take = codes[counted_up(first[a:b], size[a:b])]
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, words[done:upto] - held), pa.int32()), distinct.take(pa.array(take)))
        yield from pc.binary_join(lists, " ").view(pa.binary()).to_pylist()
        done = upto


def spans(doc: np.ndarray, mark: np.ndarray, place: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """The words under the given windows as runs per document row; windows sorted by row and place."""
    if not len(doc):
        return dict.fromkeys(("doc_id", "mark", "first", "last"), np.zeros(0, np.int64))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (place[1:] > place[:-1] + window)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(doc)) - 1
    return {"doc_id": doc[begin], "mark": mark[begin], "first": place[begin], "last": place[end] + window}


def marks(texts: pa.Array, shared_ids: bool) -> np.ndarray:
    """Tells apart rows that share an id: the CRC of the text, or nothing when no rows do."""
    if not shared_ids:
        return np.zeros(len(texts), np.int64)
    return np.fromiter((zlib.crc32(t or b"") for t in texts.cast(pa.large_binary()).to_pylist()), np.int64, len(texts))


def packed(kind: int, *arrays: np.ndarray, text: bytes = b"") -> bytes:
    """Numbers byte by byte, all first bytes, all second ones and so on, which compresses best; then the text."""
    numbers = b"".join(np.ascontiguousarray(a.astype("<i8")[:, None].view(np.uint8).T).tobytes() for a in arrays)
    return zstandard.compress(struct.pack("<BQ", kind, len(arrays[0])) + numbers + text, LEVEL)


def unpacked(blob: bytes, arrays: int) -> tuple[int, list[np.ndarray], bytes]:
    body = zstandard.decompress(blob)
    kind, count = struct.unpack_from("<BQ", body)
    head = struct.calcsize("<BQ")
    planes = np.frombuffer(body, np.uint8, 8 * count * arrays, head).reshape(arrays, 8, count)
    parts = [np.ascontiguousarray(p.T).view("<i8")[:, 0] for p in planes]
    return kind, parts, body[head + 8 * count * arrays :]


def frequent(docs: DataFrame, window: int, part: int, share: float) -> tuple[list[int], int]:
    """The minimisers that hold at least ``share`` of all super-k-mers, and the number of words."""

    def counted(texts: pa.Array) -> pa.RecordBatch:
        w = Windows(texts, window, part)
        new = np.ones(len(w.at), bool)
        new[1:] = (w.least[1:] != w.least[:-1]) | (np.diff(w.at) != 1)
        values, counts = np.unique(w.least[new], return_counts=True)
        # What stays below this everywhere stays below the share in total.
        often = counts >= share * new.sum()
        return pa.record_batch(
            {
                "least": pa.array([None, *values[often].view(np.int64).tolist()], pa.int64()),
                "runs": pa.array([int(new.sum()), *counts[often].tolist()], pa.int64()),
                "words": pa.array([len(w.codes), *[0] * int(often.sum())], pa.int64()),
            }
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BATCH_BYTES):
            yield counted(batch.column("text"))

    # No more values than the inverse of the share can reach it, so the longest ones hold them all,
    # and the row of the totals, which is the longest.
    rows = (
        docs.select("text")
        .mapInArrow(count, "least long, runs long, words long")
        .groupBy("least")
        .agg(F.sum("runs").alias("runs"), F.sum("words").alias("words"))
        .orderBy(F.desc("runs"), "least")
        .limit(int(1 / share) + 2)
        .collect()
    )
    total = next((r for r in rows if r["least"] is None), None)
    if total is None:
        return [], 0
    hot = [r["least"] for r in rows if r["least"] is not None and r["runs"] >= max(64, share * total["runs"])]
    return sorted(hot), total["words"]


def share_ids(docs: DataFrame) -> bool:
    """Whether any two rows have the same id."""
    return docs.groupBy("doc_id").count().where("doc_id is not null and count > 1").limit(1).count() > 0


def repeated_spans(
    docs: DataFrame, shared_ids: bool, window: int = WINDOW, part: int = MINIMISER, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Word ranges ``[first, last)`` of (doc_id, text) rows that a smaller doc_id has too.

    ``mark`` is that of :func:`marks`. Rows without an id or with fewer words than a window
    have no windows. Rows that share an id do not count against each other.
    """
    docs = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    hot_list, words = frequent(docs, window, part, hot_share)
    hot = np.sort(np.array(hot_list, np.int64).view(np.uint64))
    buckets = max(FEWEST_BUCKETS, words // BUCKET_WORDS)

    def dealt(texts: pa.Array, ids: np.ndarray) -> tuple[list[int], list[bytes]]:
        w = Windows(texts, window, part)
        keys, blobs = [], []
        if not len(w.at):
            return keys, blobs
        own, late = marks(texts, shared_ids), later(w, ids, window)
        if late.any():
            owner = w.owner[late]
            told = spans(ids[owner], own[owner], w.place(np.flatnonzero(late)), window)
            keys.append(int(told["doc_id"][0] % buckets))
            blobs.append(packed(0, *told.values()))
        bucket, begin, count = super_kmers(w, late, hot, buckets)
        codes, distinct, first, size = w.codes, w.distinct.cast(pa.string()), w.at[begin], count + window - 1
        owner, spot = w.owner[begin], w.place(begin)
        who, mark = ids[owner], own[owner]
        del w, late, begin, owner, count
        cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
        lines = joined_words(codes, distinct, first, size, cuts)
        for line, (a, b) in zip(lines, itertools.pairwise(np.append(cuts, len(first)))):
            keys.append(int(bucket[a]))
            step = np.diff(who[a:b], prepend=0)
            blobs.append(packed(1, step, mark[a:b], spot[a:b], size[a:b], text=line))
        return keys, blobs

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BATCH_BYTES):
            # What a batch needs is gone before the next one comes.
            keys, blobs = dealt(batch.column("text"), np.asarray(batch.column("doc_id"), dtype=np.int64))
            if keys:
                yield pa.record_batch({"bucket": pa.array(keys, pa.int64()), "packed": pa.array(blobs, pa.binary())})

    def settle(blobs: list[bytes]) -> Iterator[dict[str, np.ndarray]]:
        metas, texts = [], []
        for blob in blobs:
            kind, meta, text = unpacked(blob, 4)
            if kind:
                metas.append([np.cumsum(meta[0]), *meta[1:]])
                texts.append(text)
            else:
                yield dict(zip(("doc_id", "mark", "first", "last"), meta))
        if not metas:
            return
        ids, mark, spot, size = (np.concatenate(c) for c in zip(*metas))
        metas.clear()
        texts = pa.array(texts, pa.large_binary()).view(pa.large_string())
        codes, distinct, _ = coded_words(texts)
        del texts
        first, count = np.cumsum(size) - size, size - window + 1
        line, at = np.repeat(np.arange(len(size), dtype=np.int32), count), counted_up(first, count)
        hashes = run_hashes(block_hashes(distinct)[codes], window)[at]
        order, new = grouped(codes, hashes, at, window)
        del codes, distinct, hashes
        begin = np.flatnonzero(new)
        doc = ids[line[order]]
        least = np.repeat(np.minimum.reduceat(doc, begin), np.diff(np.append(begin, len(order))))
        late = order[doc > least]
        row = line[late]
        place = spot[row] + at[late] - first[row]
        late_order = np.lexsort((place, mark[row], ids[row]))
        row, place = row[late_order], place[late_order]
        yield spans(ids[row], mark[row], place, window)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column("bucket").to_pylist(), b.column("packed").to_pylist()))
        for _, group in itertools.groupby(rows, key=lambda r: r[0]):
            for part in settle([blob for _, blob in group]):
                yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in part.items()})

    # Partitions follow the words, so that a task reads a bounded share of them.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        docs.mapInArrow(deal, "bucket long, packed binary")
        .repartition(max(least, words // PARTITION_WORDS), "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(count, SPANS)
    )


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[list[bytes], int]:
    """The words left, and the number of all words."""
    words = text.split()
    gone = np.zeros(len(words), bool)
    for first, last in spans:
        gone[first:last] = True
    return [w for w, g in zip(words, gone.tolist()) if not g], len(words)


def remove_repeats(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    hot_share: float = HOT_SHARE,
    carry: Sequence[str] = (),
    verbatim: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept_text``.

    A word goes when a window of ``window`` words over it also begins in a document with a smaller
    id. Null texts count as empty; an empty text has no words. Rows without an id lose nothing and
    cost nobody anything. Rows that share an id are judged one by one, never against each other. Columns other than
    the two named are ignored unless ``carry`` names them. ``kept_text`` holds the words left,
    joined by one space; with ``verbatim`` the text as it was, null included, where nothing goes.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *carry)
    shared_ids = share_ids(docs)
    found = repeated_spans(docs, shared_ids, window, hot_share=hot_share)
    found = found.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carry)

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The texts travel to their spans compressed."""
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in chunks(batches, "text", BATCH_BYTES):
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "mark": pa.array(marks(batch.column("text"), shared_ids)),
                    **{c: batch.column(c) for c in carry},
                    "squeezed": pa.array([None if t is None else pack(t) for t in texts], pa.binary()),
                }
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in chunks(batches, "squeezed", BATCH_BYTES // 4):
            rows = []
            for squeezed, gone in zip(batch.column("squeezed").to_pylist(), batch.column("spans").to_pylist()):
                text_ = None if squeezed is None else unpack(squeezed)
                kept, words = without(text_ or b"", [(s["first"], s["last"]) for s in gone or ()])
                same = verbatim and len(kept) == words
                rows.append((words, words - len(kept), text_ if same else b" ".join(kept)))
            words, gone, left = zip(*rows)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    **{c: batch.column(c) for c in carry},
                    "n_words": pa.array(words, pa.int64()),
                    "n_removed": pa.array(gone, pa.int64()),
                    "kept_text": pa.array(left, pa.binary()).view(pa.string()),
                }
            )

    return (
        docs.mapInArrow(squeeze, f"doc_id long, mark long, {kinds}squeezed binary")
        .join(found, ["doc_id", "mark"], "left")
        .select("doc_id", "squeezed", *carry, "spans")
        .mapInArrow(cut, f"doc_id long, {kinds}n_words long, n_removed long, kept_text string")
    )
