"""Subword encoding with seeded merge-dropout, and its exact inverse.

The pieces of a SentencePiece model of the merging kind are built bottom up: an agenda holds every
adjacent pair that forms a piece, best first. Each candidate that comes up is skipped when a hash says so whose
key holds the seed, the document and the place of the word, so every candidate of every occurrence has its own
draw; the same seed gives the same segmentation again. Short words are merged side by side in numpy: in each
round every word takes the best pair of its own agenda, merges or skips it, and looks up the new pairs.
Blanks are written as U+2581; that character itself, and everything the vocabulary lacks, is spelled in
bytes, so every segmentation decodes to the text.
"""

from __future__ import annotations

import array
import functools
import heapq
import itertools
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from sluice.llm.words import chunks, mixed

BLANK = "▁"
DROPOUT, SEED = 0.1, 17
# The length up to which a word is short, how many of them are merged side by side, and rows decoded together.
SHORT, WORDS, DECODED = 48, 1 << 16, 256
NO_PIECE, NOTHING = float("inf"), (1 << 62)


def code(start: int, length: int) -> int:
    """A candidate of a word as a number: where it starts, and its length in characters."""
    return (start * 0x85EBCA6B ^ length * 0xC2B2AE35) & 0xFFFFFFFF


def spread(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges, range by range, with the number of the range each belongs to."""
    sizes = ends - begins
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) + (begins - (np.cumsum(sizes) - sizes))[owner]


class PairTable:
    """Rank and result of every pair of symbols that forms a piece, in an open-addressed table of arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], symbols: int):
        self.symbols = symbols
        self.bits = max(10, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NOTHING, np.int64)
        for (a, b), (rank, merged) in pairs.items():
            key = a * symbols + b
            at = int(self.place(np.array([key]))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & (len(self.keys) - 1)
            self.keys[at], self.values[at] = key, rank << 32 | merged

    def place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``rank << 32 | result`` of each pair, or NOTHING."""
        keys = np.where((a < self.symbols) & (b < self.symbols), a * self.symbols + b, -2)
        at = self.place(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], NOTHING)
        left = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out


class MergeEncoder:
    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.bytes_ = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        usual = [i for i in range(size) if not special[i] and not model.is_byte(i)]
        self.ids = {model.id_to_piece(i): i for i in usual}
        self.ranks = {p: -model.get_score(i) for p, i in self.ids.items()}
        if any("\n" in p or BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("pieces reach over blanks or lines")
        self.texts = [b""] * size
        for p, i in self.ids.items():
            self.texts[i] = p.replace(BLANK, " ").encode()
        for value, i in self.bytes_.items():
            self.texts[i] = bytes([value])
        self.text_bytes = np.frombuffer(b"".join(self.texts), np.uint8)
        self.text_ends = np.append(0, np.cumsum([len(t) for t in self.texts]))
        self.below = int(dropout * 2**32)
        self.seed = seed
        self.index()

    def index(self) -> None:
        """Number the symbols: all pieces, and the characters in them. Other characters count up behind."""
        names = list(dict.fromkeys([*self.ids, *(c for p in self.ids for c in p)]))
        number = {p: n for n, p in enumerate(names)}
        self.of_char = np.arange(0x110000, dtype=np.int64) + len(names)
        for p, n in number.items():
            if len(p) == 1:
                self.of_char[ord(p)] = n
        self.of_char[ord(" ")] = self.of_char[ord(BLANK)]
        self.id_of = np.array([self.ids.get(p, -1) for p in names])
        self.names = names
        order = {r: n for n, r in enumerate(sorted(set(self.ranks.values())))}
        pairs = {}
        for p, rank in self.ranks.items():
            for cut in range(1, len(p)):
                a, b = number.get(p[:cut]), number.get(p[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (order[rank], number[p])
        self.pairs = PairTable(pairs, len(names))

    def skipped(self, key: int, start: int, length: int) -> bool:
        """Whether the keyed hash skips the candidate at a character, of a length in characters."""
        return ((key ^ code(start, length)) * 0x9E3779B1 & 0xFFFFFFFF) < self.below

    def merge(self, part: str, variant: int) -> bytes:
        """The ids of a word (with the blanks before it), as 32-bit numbers."""
        key = zlib.crc32(part.encode("utf-8", "surrogatepass"), (self.seed * 0x9E3779B1 + variant) & 0xFFFFFFFF)
        return self.merge_all([part], np.array([key], np.uint32))[0].tobytes()

    def merge_short(self, chars: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words and how many each has, merged side by side: in a round every word takes the best pair of its agenda.

        ``chars`` has the characters of all words, ``sizes`` their numbers, ``keys`` the keys of the draws.
        """
        symbol, length = self.of_char[chars], np.ones(len(chars), np.int64)
        word, ends = np.arange(len(sizes)), np.cumsum(sizes)
        start = np.arange(len(chars)) - np.repeat(ends - sizes, sizes)
        # The agenda: what the pair of each symbol and the next one in its word would give.
        agenda = np.append(self.pairs.find(symbol[:-1], symbol[1:]), NOTHING)
        agenda[ends - 1] = NOTHING
        done = []
        while len(word):
            begins = np.cumsum(sizes) - sizes
            # Equal ranks: the leftmost comes up first.
            best = np.minimum.reduceat((agenda >> 32 << 32) + np.arange(len(agenda)), begins)
            over = best >> 32 == NOTHING >> 32
            goes = np.repeat(over, sizes)
            if over.any():
                done.append((word[over], sizes[over], symbol[goes]))
            at, key = (best & 0xFFFFFFFF)[~over], keys[word[~over]]
            joined = length[at] + length[at + 1 - (at + 1 == len(length))]
            mark = start[at].astype(np.uint32) * np.uint32(0x85EBCA6B) ^ joined.astype(np.uint32) * np.uint32(0xC2B2AE35)
            skip = ((key ^ mark) * np.uint32(0x9E3779B1)).astype(np.uint64) < self.below
            agenda[at[skip]] = NOTHING
            at, joined = at[~skip], joined[~skip]
            symbol[at], length[at] = agenda[at] & 0xFFFFFFFF, joined
            goes[at + 1] = True
            # Words keep their order, and of each at least the symbol at its begin.
            last = np.zeros(len(symbol), bool)
            last[begins + sizes - 1] = True
            after = np.minimum(at + 2, len(symbol) - 1)
            agenda[at] = np.where(last[at + 1], NOTHING, self.pairs.find(symbol[at], symbol[after]))
            inner = start[at] > 0
            before, now = at[inner] - 1, at[inner]
            agenda[before] = self.pairs.find(symbol[before], symbol[now])
            sizes[np.flatnonzero(~over)[~skip]] -= 1
            word, sizes = word[~over], sizes[~over]
            stays = ~goes
            symbol, length, start, agenda = symbol[stays], length[stays], start[stays], agenda[stays]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        words, sizes, symbols = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(words, kind="stable")
        ends = np.cumsum(sizes)
        return symbols[spread((ends - sizes)[order], ends[order])[1]], sizes[order]

    def ids_of(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of symbols, and how many each word has; what is not in the vocabulary is spelled in bytes."""
        known = symbols < len(self.names)
        ids = np.where(known, self.id_of[np.where(known, symbols, 0)], -1)
        if (ids >= 0).all():
            return ids.astype(np.uint32), sizes
        lost = np.flatnonzero(ids < 0)
        spelled = {}
        for n in np.unique(symbols[lost]).tolist():
            char = self.names[n] if n < len(self.names) else chr(n - len(self.names))
            spelled[n] = [self.bytes_[b] for b in char.encode("utf-8", "surrogatepass")]
        each = np.ones(len(ids), np.int64)
        each[lost] = [len(spelled[n]) for n in symbols[lost].tolist()]
        ends = np.cumsum(each)
        out = np.repeat(ids, each)
        for n, value in spelled.items():
            places = lost[symbols[lost] == n]
            for step, byte in enumerate(value):
                out[ends[places] - len(value) + step] = byte
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return out.astype(np.uint32), np.bincount(owner, each, len(sizes)).astype(np.int64)

    def merge_chars(self, text: str, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts of a text in order, and how many each part has; ``sizes`` has their numbers of characters."""
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(sizes)
        apart = np.zeros(len(sizes), bool)
        apart[np.searchsorted(ends, np.flatnonzero(chars == ord(BLANK)), "right")] = True
        apart |= sizes > SHORT
        found, counts = [], np.zeros(len(sizes), np.int64)
        # Short parts go block by block; long ones, and those with a character that looks like a blank, one by one.
        cuts = np.unique(np.concatenate([np.arange(0, len(sizes), WORDS), np.flatnonzero(apart), np.flatnonzero(apart) + 1, [len(sizes)]]))
        for a, b in itertools.pairwise(cuts.tolist()):
            begin = int(ends[a] - sizes[a])
            if apart[a]:
                ids = np.frombuffer(self.merge_long(text[begin : int(ends[a])], int(keys[a])), np.uint32)
                counts[a] = len(ids)
            else:
                ids, counts[a:b] = self.ids_of(*self.merge_short(chars[begin : int(ends[b - 1])], sizes[a:b].copy(), keys[a:b]))
            found.append(ids)
        return np.concatenate(found) if found else np.zeros(0, np.uint32), counts

    def merge_all(self, parts: Sequence[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in order, and how many each part has; ``keys`` has the key of each part's draws."""
        return self.merge_chars("".join(parts), np.fromiter(map(len, parts), np.int64, len(parts)), keys)

    def merge_long(self, part: str, key: int) -> bytes:
        """The same with a heap for the agenda and linked signs, for parts of any length."""
        # A character that stands for a blank must not be taken for one.
        signs = [BLANK if c == " " else c for c in part]
        literal = {i for i, c in enumerate(part) if c == BLANK}
        after = list(range(1, len(signs) + 1))
        before = list(range(-1, len(signs) - 1))
        rank, none, agenda = self.ranks.get, NO_PIECE, []
        size = [1] * len(signs)

        def offer(i: int, j: int) -> None:
            if i not in literal and j not in literal and (found := rank(signs[i] + signs[j], none)) < none:
                heapq.heappush(agenda, (found, i, size[i] + size[j]))

        for i in range(len(signs) - 1):
            offer(i, i + 1)
        while agenda:
            _, i, length = heapq.heappop(agenda)
            j = after[i] if size[i] else len(signs)
            if j >= len(signs) or size[i] + size[j] != length:
                continue  # one of the two has become part of another piece
            if self.skipped(key, i, length):
                continue
            signs[i] += signs[j]
            size[i], size[j] = length, 0
            k = after[i] = after[j]
            if k < len(signs):
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        ids = array.array("I")
        i = 0
        while i < len(signs):
            found = None if i in literal else self.ids.get(signs[i])
            ids.extend([self.bytes_[b] for b in signs[i].encode("utf-8", "surrogatepass")] if found is None else [found])
            i = after[i]
        return ids.tobytes()

    def encode(self, text: str, stream: int = 0) -> np.ndarray:
        """The ids of a text; ``stream`` is the document's part of the draws' keys."""
        return self.encode_all([text], np.array([stream], np.uint64))[0]

    def encode_all(self, texts: Sequence[str], streams: np.ndarray) -> list[np.ndarray]:
        """The ids of each text, with the document's part of the draws' keys for each."""
        whole = "".join(texts)
        chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        # Blanks belong to the word after them; no piece holds a line end, which is a part of its own.
        line, blank = chars == ord("\n"), chars == ord(" ")
        begins = line.copy()
        begins[1:] |= line[:-1] | (blank[1:] & ~blank[:-1])
        begins[(ends - sizes)[sizes > 0]] = True
        parts = np.flatnonzero(begins)
        owner = np.searchsorted(ends, parts, "right")
        per_text = np.bincount(owner, minlength=len(texts))
        place = np.arange(len(parts)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        starts = mixed(mixed(np.full(1, self.seed & 0xFFFFFFFFFFFFFFFF, np.uint64) + np.uint64(1)) + streams)
        keys = mixed(starts[owner] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        ids, counts = self.merge_chars(whole, np.diff(np.append(parts, len(chars))), (keys >> np.uint64(32)).astype(np.uint32))
        upto = np.append(0, np.cumsum(counts))[np.cumsum(per_text)]
        return np.split(ids, upto[:-1]) if len(texts) else []

    def decode(self, ids) -> str:
        return b"".join([self.texts[i] for i in ids]).decode("utf-8", "surrogatepass")

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of several lists of ids, given by where each ends, starting with 0."""
        size = self.text_ends[ids + 1] - self.text_ends[ids]
        flat = self.text_bytes[spread(self.text_ends[ids], self.text_ends[ids + 1])[1]]
        offsets = np.append(0, np.cumsum(size))[ends]
        texts = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes()))
        texts.validate(full=True)  # ids of another origin may not be UTF-8
        return texts


@functools.lru_cache(maxsize=2)
def encoder_of(path: str, dropout: float = DROPOUT, seed: int = SEED) -> MergeEncoder:
    """One encoder per Python worker, so that the tables are built once."""
    return MergeEncoder(path, dropout, seed)


def encode(
    docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text", dropout: float = DROPOUT, seed: int = SEED, carry: Sequence[str] = ()
) -> DataFrame:
    """``doc_id, ids, ids_crc32`` of every row; a null text has null ids, an empty text none.

    ``ids_crc32`` is that of the ids as little-endian 32-bit numbers. The segmentation depends on the
    text, the id (0 if null) and the seed only, so repeated rows agree; a word's other occurrences and the
    same text under other ids are segmented independently. Columns named in ``carry`` come along (not those three names), others are
    ignored. A text is encoded whole in one task, with some 40 bytes a character.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model, dropout, seed)
        for batch in chunks(batches, "text", 2 << 20):
            numbers = np.array([i or 0 for i in batch.column("doc_id").to_pylist()], np.int64).view(np.uint64)
            texts = batch.column("text").to_pylist()
            some = [n for n, t in enumerate(texts) if t is not None]
            of_text = np.array([xxhash.xxh64_intdigest(texts[n].encode("utf-8", "surrogatepass")) for n in some], np.uint64)
            ids = [None] * len(texts)
            for n, found in zip(some, encoder.encode_all([texts[n] for n in some], mixed(numbers[some]) ^ of_text)):
                ids[n] = found
            sizes = np.array([0 if i is None else len(i) for i in ids])
            flat = np.concatenate([np.zeros(0, "<u4"), *[i for i in ids if i is not None]]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(flat), mask=pa.array([i is None for i in ids]))
            crcs = pa.array([None if i is None else zlib.crc32(i.tobytes()) for i in ids], pa.int64())
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "ids": lists, "ids_crc32": crcs, **{c: batch.column(c) for c in carry}})

    more = [c for c in carry if c not in ("doc_id", "ids", "ids_crc32", "text")]
    if len(more) < len(carry):
        raise ValueError("carried columns may not be called doc_id, text, ids or ids_crc32")
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *carry)
    kinds = [f"`{c}` {t}" for c, t in docs.dtypes if c in more]
    return docs.mapInArrow(work, ", ".join(["doc_id long, ids array<int>, ids_crc32 long", *kinds]))


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The other columns with ``text`` in place of the ids (and of a column of that name); null ids give null, no ids an empty text.

    Ids that do not spell UTF-8 are an error. A text is decoded whole in one task, with some 30 bytes an id.
    """
    docs = encoded.drop("text") if ids != "text" else encoded
    kinds = [f"`{c}` {t}" for c, t in docs.dtypes if c != ids]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(model)
        for batch in batches:
            for begin in range(0, batch.num_rows, DECODED):
                rows = batch.slice(begin, DECODED)
                lists = rows.column(ids)
                ends = np.append(0, np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0))))
                texts = encoder.decode_all(np.asarray(lists.flatten()), ends)
                texts = pc.if_else(lists.is_valid(), texts.cast(pa.string()), pa.scalar(None, pa.string()))
                rest = [c for c in rows.schema.names if c != ids]
                yield rows.select(rest).append_column("text", texts)

    return docs.mapInArrow(work, ", ".join([*kinds, "text string"]))
