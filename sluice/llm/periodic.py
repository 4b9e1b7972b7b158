"""Runs of periodically repeated words, found on a grammar of each text.

Re-Pair replaces pairs of neighbouring symbols that occur twice or more by a new symbol, the most frequent ones
first, until no pair occurs twice; what is left of a text is halved into pairs of pairs. A run of words
lies in the expansion of some symbol and crosses the boundary between its two parts (take the smallest symbol that
holds it). So runs are looked for across the boundary of each symbol only, once per symbol, at its first place:
a run of four periods has two of them on one side of the boundary, hence a square that begins or ends there.
What is found is translated to every place of the symbol, and overlapping finds of one period are merged.

All texts of a batch are worked on together in numpy. In one round of Re-Pair every text replaces its most
frequent pair and the less frequent ones wherever no more frequent pair overlaps them. The symbols of a round
lie side by side, so the search for runs costs a few operations per word and round.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from sluice.llm.words import chunks, coded, split_words

# A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
BATCH_BYTES = 4 << 20
# Candidates for a period looked at together.
BLOCK = 1 << 21

FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
PRIME = (1 << 31) - 1


@dataclass
class Symbols:
    """The symbols of the batch's texts in order: where each begins (in words of the batch), and how many words it stands for."""

    code: np.ndarray
    text: np.ndarray
    start: np.ndarray
    size: np.ndarray
    fresh: np.ndarray  # whether the pair that begins here may occur twice


class Prefixes:
    """Prefix sums modulo a prime, by which any two stretches of words are compared at once."""

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng([seed, 12])
        self.sums, self.powers = [], []
        for _ in range(2):
            base = int(rng.integers(1 << 20, PRIME))
            powers = np.ones(1, np.int64)
            while len(powers) <= len(words):
                powers = np.concatenate([powers, powers * pow(base, len(powers), PRIME) % PRIME])
            powers = powers[: len(words) + 1]
            # Sums of fewer than 2**32 values below 2**31 fit.
            self.sums.append(np.concatenate([[0], np.cumsum((words + 1) % PRIME * powers[:-1] % PRIME)]) % PRIME)
            self.powers.append(powers)

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the words from ``a`` equal those from ``b``, where ``a <= b``."""
        same = np.ones(len(a), bool)
        for sums, powers in zip(self.sums, self.powers):
            left = (sums[a + length] - sums[a]) % PRIME * powers[b - a] % PRIME
            same &= left == (sums[b + length] - sums[b]) % PRIME
        return same

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words, at most ``most``, are equal from ``a`` and ``b`` on, or before them."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(a - middle, b - middle, middle) if back else self.equal(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the ranges 0..size-1, one after another: the number of its range, and the place in it."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def crossing(words: np.ndarray, prefixes: Prefixes, low: np.ndarray, middle: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """``symbol, start, end, period`` of the runs across ``middle`` inside of ``low`` to ``high``."""
    out = []
    for back in (False, True):
        # A square of the period begins (or ends) at the boundary, and the run is four periods long.
        most = np.minimum((middle - low if back else high - middle) // 2, (high - low) // LEAST_PERIODS)
        most = np.where(high - low >= LEAST_WORDS, np.maximum(most, 0), 0)
        some = np.flatnonzero(most)
        upto = np.cumsum(most[some])
        begin = 0
        while begin < len(some):
            done = upto[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(upto, done + BLOCK, "right")))
            owner, period = ranges(most[some[begin:end]])
            owner, period = some[begin + owner], period + 1
            begin = end
            at = middle[owner]
            for step in range(2):  # most candidates fail on their first words
                near = at - 1 - step if back else at + step
                other = near - period if back else near + period
                same = (words[near] == words[np.minimum(other, len(words) - 1)]) | (step >= period)
                owner, period, at = owner[same], period[same], at[same]
            first = at - 2 * period if back else at
            square = prefixes.equal(first, first + period, period)
            owner, period, at = owner[square], period[square], at[square]
            if not len(owner):
                continue
            lo, hi = low[owner], high[owner]
            anchor = at - period if back else at
            start = anchor - prefixes.common(anchor, anchor + period, anchor - lo, back=True)
            stop = anchor + period + prefixes.common(anchor, anchor + period, hi - anchor - period)
            size = stop - start
            long = (size >= LEAST_WORDS) & (size >= LEAST_PERIODS * period) & (start < at) & (at < stop)
            out.append((owner[long], start[long], stop[long], period[long]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.zeros(0, np.int64) for _ in range(4))


def round_of_pairs(s: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """One round of Re-Pair: where pairs are replaced, the number of the pair at each, and the first place of each pair.

    ``s.fresh`` is left with the pairs that the next round must count.
    """
    left = np.flatnonzero(s.fresh)
    a, b = s.code[left], s.code[left + 1]
    key = a * (int(s.code.max()) + 1) + b  # symbols are numbered apart for each text
    order = np.argsort(key)
    new = np.flatnonzero(np.diff(key[order], prepend=-1))
    pair = np.empty(len(left), np.int64)
    pair[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))
    # In a row of equal symbols only every second pair counts, from its first one on.
    same, index = a == b, np.arange(len(left))
    goes_on = np.zeros(len(left), bool)
    goes_on[1:] = same[1:] & same[:-1] & (left[1:] == left[:-1] + 1)
    counted = (index - np.maximum.accumulate(np.where(goes_on, 0, index))) % 2 == 0
    counts = np.bincount(pair[counted], minlength=len(new))
    often = counts[pair] >= 2
    # A pair that occurs once will never occur twice.
    s.fresh[left[~often]] = False
    left, pair = left[often & counted], pair[often & counted]
    # Of overlapping pairs the more frequent one is replaced; of equally frequent ones, the one numbered first.
    rank = np.zeros(len(s.code) + 1, np.int64)
    rank[left] = counts[pair] * len(new) + (len(new) - pair)
    chosen = (rank[left] >= rank[left + 1]) & (rank[left] >= rank[left - 1])
    left, pair = left[chosen], pair[chosen]
    used = np.bincount(pair, minlength=len(new)) >= 2
    left, pair = left[used[pair]], (np.cumsum(used) - 1)[pair[used[pair]]]
    if not len(left):
        return None
    first = np.zeros(int(used.sum()), np.int64)
    first[pair[::-1]] = np.arange(len(left))[::-1]
    return left, pair, first


def joined_symbols(s: Symbols, left: np.ndarray) -> Symbols:
    """Each symbol at ``left`` becomes one with the symbol after it."""
    stays = np.ones(len(s.text), bool)
    stays[left + 1] = False
    s.size[left] += s.size[left + 1]
    # The new symbols make new pairs on both sides.
    text = np.append(s.text, [-1, -1])
    s.fresh[left] = text[left + 2] == text[left]
    s.fresh[left - 1] = text[left - 1] == text[left]
    return Symbols(s.code[stays], s.text[stays], s.start[stays], s.size[stays], s.fresh[stays])


def grammar_runs(words: np.ndarray, sizes: np.ndarray, seed: int = 0) -> tuple[np.ndarray, ...]:
    """``start, end, period`` (in words of the batch) of finds in all texts; the ones of a run that goes beyond a symbol are parts of it."""
    prefixes = Prefixes(words, seed)
    text = np.repeat(np.arange(len(sizes)), sizes)
    # Symbols are told apart by text, so that each text has its own grammar.
    _, code = np.unique(text * (int(words.max()) + 1) + words, return_inverse=True)
    fresh = np.append(text[1:] == text[:-1], False)
    s = Symbols(code.astype(np.int64), text, np.arange(len(words)), np.ones(len(words), np.int64), fresh)
    found = []

    def look(start: np.ndarray, middle: np.ndarray, end: np.ndarray, of: np.ndarray, places: np.ndarray) -> None:
        """Find the runs of symbols at their first places, and note them at all ``places``; ``of`` is the symbol at each."""
        symbol, first, stop, period = crossing(words, prefixes, start, middle, end)
        if not len(symbol):
            return
        by = np.argsort(of, kind="stable")
        counts = np.bincount(of, minlength=len(start))
        begins = np.cumsum(counts) - counts
        run, place = ranges(counts[symbol])
        shift = places[by[begins[symbol[run]] + place]] - start[symbol[run]]
        found.append((first[run] + shift, stop[run] + shift, period[run]))

    while (made := round_of_pairs(s)) is not None:
        left, pair, first = made
        at = left[first]
        look(s.start[at], s.start[at + 1], s.start[at + 1] + s.size[at + 1], pair, s.start[left])
        s.code[left] = int(s.code.max()) + 1 + pair
        s = joined_symbols(s, left)
    while True:  # what is left of each text: neighbours become one, each pair once
        counts = np.bincount(s.text, minlength=len(sizes))
        place = np.arange(len(s.text)) - np.repeat(np.cumsum(counts) - counts, counts)
        left = np.flatnonzero((place % 2 == 0) & (place + 1 < counts[s.text]))
        if not len(left):
            break
        look(s.start[left], s.start[left + 1], s.start[left + 1] + s.size[left + 1], np.arange(len(left)), s.start[left])
        s = joined_symbols(s, left)
    return tuple(np.concatenate(c) for c in zip(*found)) if found else tuple(np.zeros(0, np.int64) for _ in range(3))


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """The maximal runs, each with its smallest period, in the order of start and period."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    # Finds of one period that share a period's length are parts of one run. Its own find comes first or covers the others.
    reach = end.copy()
    fresh = np.ones(len(start), bool)
    if len(start):
        group = np.cumsum(np.diff(period, prepend=-1) != 0)
        span = int(end.max()) + 1
        reach = np.maximum.accumulate(group * span + end) - group * span
        fresh[1:] = (group[1:] != group[:-1]) | (start[1:] + period[1:] > reach[:-1])
    heads = np.flatnonzero(fresh)
    start, period = start[heads], period[heads]
    end = np.maximum.reduceat(end, heads) if len(heads) else end
    # A multiple of the period of a run has the same run.
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    own = np.ones(len(start), bool)
    own[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[own], end[own], period[own]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def holds(words: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> bool:
    """Whether every run has its period, in words, and ends where it must: what the prefix sums said, checked exactly."""
    run, place = ranges(end - start - period)
    at = start[run] + place
    if (words[at] != words[at + period[run]]).any():
        return False
    before, inside = np.maximum(start - 1, 0), start
    grows = (start > 0) & (text[before] == text[inside]) & (words[before] == words[before + period])
    after = np.minimum(end, len(words) - 1)
    grows |= (end < len(words)) & (text[after] == text[inside]) & (words[after] == words[after - period])
    return not grows.any()


def runs_of(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """``text, start, length, period`` of every run, by text, start and period; starts count from the text's first word."""
    begins = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    seed = 0
    while len(words):
        start, end, period = merged(*grammar_runs(words, sizes, seed))
        if holds(words, text, start, end, period):
            return text[start], start - begins[text[start]], end - start, period
        seed += 1  # two stretches had equal sums by chance
    return tuple(np.zeros(0, np.int64) for _ in range(4))


def joined(names: list[str], codes: np.ndarray, sizes: np.ndarray) -> list[str]:
    """The words of each text, given by their numbers, with a blank between them."""
    ends, words = np.cumsum(sizes).tolist(), map(names.__getitem__, codes.tolist())
    return [" ".join(itertools.islice(words, size)) for size in np.diff(ends, prepend=0).tolist()]


def collapsed(names: list[str], codes: np.ndarray, sizes: np.ndarray, text: np.ndarray, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[str]:
    """The texts without what repeats in a run: of each run its first period stays, unless another run drops it."""
    begins = np.cumsum(sizes) - sizes
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, begins[text] + start + period, 1)
    np.add.at(change, begins[text] + start + length, -1)
    keep = np.cumsum(change[:-1]) == 0
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return joined(names, codes[keep], np.bincount(owner[keep], minlength=len(sizes)))


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_words, runs, collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch of words in which words ``period`` apart are
    equal, with no smaller period, of at least six words and four periods, that no neighbouring word prolongs. ``runs``
    holds all of them as ``start, length, period`` by start, then period. ``collapsed`` is the words joined by one blank,
    without those that lie behind the first period of any run.

    A null or empty text has no words, no runs and an empty ``collapsed``. Rows with null or repeated ids are worked on
    each by itself. Other columns are ignored. A text is handled whole in one task, with some 300 bytes a word.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BATCH_BYTES):
            words, sizes = split_words(batch.column("text"))
            codes, distinct = coded(words)
            of, start, length, period = runs_of(codes, sizes)
            ends = np.append(0, np.cumsum(np.bincount(of, minlength=len(sizes))))
            structs = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], ["start", "length", "period"])
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": pa.array(sizes),
                    "runs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
                    "collapsed": pa.array(collapsed(distinct.to_pylist(), codes, sizes, of, start, length, period), pa.string()),
                }
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {FOUND}")
