"""Packing token sequences into windows of a fixed length by best-fit decreasing.

Documents longer than a window are first cut into full windows; what is left of them is packed with
the shorter documents. The pieces are dealt into groups of a bounded size; each group is packed
alone: longest piece first, each into the open window with the tightest room, found by a segment
tree over the remaining capacities. Only lengths travel; ids are counted and hashed where they are made.
"""

from __future__ import annotations

import functools
import itertools
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from sluice.llm.words import CHUNK_BYTES, chunks, coded, split_words

LENGTH = 4096
# Pieces packed together by one task. More groups leave more windows open at their ends: at most a few each.
GROUP_PIECES = 40_000

PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class RoomTree:
    """How many open windows have each remaining capacity, as a segment tree over the capacities."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.count[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(room, window)`` with the least room of at least ``need``."""
        at = need + self.size
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        self._change(room, -1)
        return room, self.open[room].pop()


def best_fit(lengths: Sequence[int], most: int) -> tuple[list[int], list[int]]:
    """Window and offset of each piece; ``lengths`` must fall and lie between 1 and ``most``."""
    tree, windows = RoomTree(most), 0
    where, offset = [], []
    for need in lengths:
        found = tree.take(need)
        if found is None:
            found = (most, windows)
            windows += 1
        room, window = found
        where.append(window)
        offset.append(most - room)
        if room > need:
            tree.add(room - need, window)
    return where, offset


def gathered(pool: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges of ``pool`` named in ``which``, one after another, and their sizes; range n lies between ``ends[n]`` and ``ends[n + 1]``."""
    begin, size = ends[which], ends[which + 1] - ends[which]
    upto = np.cumsum(size)
    take = np.repeat(begin - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
    return pool[take], size


class WordEncoder:
    """Token ids of texts by a tokenizer that treats blank-separated words alone, each word encoded once.

    ``word_bpe_49k.json`` is such a tokenizer: it drops white space and the case, and none of its rules
    reaches over a blank, or from a letter over the full stop or comma after it. Words that may hold one of its special
    strings are given to it as they are.
    """

    MOST = 400_000  # words remembered
    # Characters encoded at once, as the tokenizer keeps some hundred bytes for each token, and words whose ids are put together at once.
    AT_ONCE, BLOCK_WORDS = 1 << 18, 1 << 16

    def __init__(self, path: str, end: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end], np.uint32)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.pool, self.ends = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for n, text in enumerate(texts, 1):
            held.append(text)
            size += len(text) + 8
            if size >= self.AT_ONCE or n == len(texts):
                for e in self.tokenizer.encode_batch_fast(held, add_special_tokens=False):
                    yield np.array(e.ids, np.uint32)
                held, size = [], 0

    def learn(self, words: pa.Array) -> None:
        """Encode new words: those of letters alone many to a text, told apart by the ids that end a word."""
        letters = pc.utf8_is_alpha(words)
        plain = words.filter(letters)
        groups = [plain.slice(n, 500) for n in range(0, len(plain), 500)]
        names, found, sizes = [], [], []
        alone = [words.filter(pc.invert(letters))]
        for group, ids in zip(groups, self.encoded([" ".join(g.to_pylist()) for g in groups])):
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) != len(group):
                alone.append(group)
                continue
            names.append(group)
            found.append(ids)
            sizes.append(np.diff(ends, prepend=0))
        rest = pa.concat_arrays(alone)
        each = list(self.encoded(rest.to_pylist()))
        sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
        self.known = pa.concat_arrays([self.known, *names, rest])
        self.pool = np.concatenate([self.pool, *found, *each])
        self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes)))

    def places(self, words: pa.Array) -> np.ndarray:
        """Where the ids of each word are remembered; new words are encoded."""
        if len(self.known) > self.MOST:
            self.forget()
        at = pc.index_in(words, value_set=self.known)
        if at.null_count:
            self.learn(words.filter(at.is_null()).unique())
            at = pc.index_in(words, value_set=self.known)
        return np.asarray(at, dtype=np.int64)

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words in order, and how many each has. Marks at the end of a word are encoded apart from it."""
        as_it_is = pc.or_(pc.match_substring(words, "<|"), pc.invert(pc.string_is_ascii(words)))
        words = pc.if_else(as_it_is, words, pc.ascii_lower(words))
        stems = pc.ascii_rtrim(words, characters=".,;:!?")
        cut = pc.and_(pc.match_substring_regex(stems, "[A-Za-z]$"), pc.less(pc.binary_length(stems), pc.binary_length(words)))
        tails = pc.replace_substring_regex(words.filter(cut), "(?s)^.*[A-Za-z]", "")
        parts, distinct = coded(pa.concat_arrays([pc.if_else(cut, stems, words), tails]))
        at = self.places(distinct)[parts]
        # The tail of a word follows its stem.
        order = np.insert(at[: len(words)], np.flatnonzero(np.asarray(cut)) + 1, at[len(words) :])
        ids, size = gathered(self.pool, self.ends, order)
        more = np.flatnonzero(np.asarray(cut))
        own = np.delete(np.arange(len(order)), more + 1 + np.arange(len(more)))
        return ids, np.add.reduceat(size, own) if len(own) else np.zeros(0, np.int64)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text and the closing one."""
        words, sizes = split_words(texts)
        codes, distinct = coded(words)
        del words
        codes = codes.astype(np.int32)
        ids, length = self.ids_of(distinct)
        ids, ends = np.append(ids, self.end), np.append(0, np.cumsum(np.append(length, 1)))
        upto, done, out = np.cumsum(sizes), 0, []
        while done < len(sizes):
            held = int(upto[done - 1]) if done else 0
            last = max(done + 1, int(np.searchsorted(upto, held + self.BLOCK_WORDS, "right")))
            # After the words of each text comes the closing id.
            block = np.insert(codes[held : upto[last - 1]], upto[done:last] - held, len(distinct))
            found, size = gathered(ids, ends, block)
            out += np.split(found, np.cumsum(size)[np.cumsum(sizes[done:last] + 1) - 1])[:-1]
            done = last
        return out


@functools.lru_cache(maxsize=2)
def word_encoder(path: str, end: int) -> WordEncoder:
    """One encoder per Python worker, so that later tasks find the words of earlier ones."""
    return WordEncoder(path, end)


def pieces(docs: DataFrame, encoder: Callable[[], Callable[[pa.Array], list[np.ndarray]]], most: int) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` of every document, cut at full windows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        for batch in chunks(batches, "text", CHUNK_BYTES):
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text"))):
                for start in range(0, len(ids), most):
                    part = ids[start : start + most]
                    rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
            names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
            yield pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*rows))})

    return docs.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(cut: DataFrame, groups: int, most: int = LENGTH) -> DataFrame:
    """Give every piece a sequence and an offset in it.

    Pieces are dealt over ``groups`` by a hash of what they are, so equal input gives equal output.
    A sequence is numbered by its group and its place in the group.
    """
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        for group, members in itertools.groupby(rows, key=lambda r: r[-1]):
            members = list(members)
            where, offset = best_fit([-r[0] for r in members], most)
            columns = list(zip(*members))
            yield pa.record_batch(
                {
                    "doc_id": pa.array(columns[1], pa.int64()),
                    "start": pa.array(columns[2], pa.int64()),
                    "length": -pa.array(columns[0], pa.int64()).to_numpy(),
                    "ids_crc32": pa.array(columns[3], pa.int64()),
                    "doc_tokens": pa.array(columns[4], pa.int64()),
                    "sequence_id": np.array(where, np.int64) + (group << 24),
                    "offset": np.array(offset, np.int64),
                }
            )

    return (
        dealt.select((-F.col("length")).alias("size"), "doc_id", "start", "ids_crc32", "doc_tokens", "group")
        .repartition("group")
        .sortWithinPartitions("group", "size", "doc_id", "start", "ids_crc32")
        .mapInArrow(fit, PACKED)
    )


def pack_documents(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 2, most: int = LENGTH, group_pieces: int = GROUP_PIECES
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its token ids and the id ``end``; a null or empty text is that id alone. Each id
    lies in one piece, offsets in a sequence have no gaps, and sequences hold at most ``most`` ids.
    Rows with null or repeated ids are packed as they are. Other columns are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # A count of rows is enough to choose the groups; a long document only adds full windows.
    groups = max(1, -(-docs.count() // group_pieces))
    return pack(pieces(docs, lambda: word_encoder(tokenizer, end), most), groups, most)
