"""Quality rules on repetition: how much of a text lies in word n-grams and lines that it holds more than once.

The words of a batch of texts become numbers, and rolling hashes of growing length are taken over them in numpy: a
window's hash is that of the window one word shorter, times a constant, plus the next word. Windows with equal
hashes are compared word by word, so no collision counts. A window can only be found twice if both windows inside
of it are, so longer windows are looked for among these alone. A text never leaves its task; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from sluice.llm.words import chunks, coded, mixed, split_words, word_hashes

# Most characters, in percent of those in words, that may lie in windows of so many words that repeat an earlier one.
GRAM_SHARES = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
# The same for lines that repeat an earlier one.
LINE_SHARE = 20
# The window of the base rule, the most words in percent it may cover, and the fewest words of a text.
BASE_WINDOW, BASE_SHARE, FEWEST_WORDS = 8, 30, 20
SYMBOLS = "[#*$%&|<>]"
BLANKS = "[\\x20\\x09-\\x0D]"
BATCH_BYTES = 4 << 20

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, dup_line_chars long, n_repeat_words long, gram_chars array<long>"


def repeated(codes: np.ndarray, hashes: np.ndarray, owner: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of the windows at ``starts`` whose words stand in the same text at another of ``starts``, and of these the ones that are not the first."""
    salt = 0
    while True:
        keys = mixed(hashes[starts] ^ mixed(owner[starts].astype(np.uint64) + np.uint64(salt << 40)))
        order = np.argsort(keys)
        same = np.flatnonzero(keys[order[1:]] == keys[order[:-1]])
        a, b = starts[order[same]], starts[order[same + 1]]
        equal = owner[a] == owner[b]
        for step in range(length):
            equal &= codes[a + step] == codes[b + step]
        if equal.all():
            found = np.zeros(len(starts), bool)
            found[order[same]] = found[order[same + 1]] = True
            keys, starts = keys[found], starts[found]
            order = np.lexsort((starts, keys))
            again = np.flatnonzero(keys[order[1:]] == keys[order[:-1]]) + 1
            return starts, starts[order[again]]
        # Different windows met: number the windows themselves.
        salt += 1
        rows = np.stack([owner[starts], *(codes[starts + step] for step in range(length))], axis=1)
        hashes = hashes.copy()
        hashes[starts] = np.unique(rows, axis=0, return_inverse=True)[1].astype(np.uint64)


def covered(starts: np.ndarray, length: int, count: int) -> np.ndarray:
    """Which of ``count`` words lie in a window at one of ``starts``."""
    change = np.zeros(count + 1, np.int64)
    change[starts] += 1
    change[starts + length] -= 1
    return np.cumsum(change[:-1]) > 0


def gram_coverage(codes: np.ndarray, word_keys: np.ndarray, sizes: np.ndarray, lengths: range) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per window length, which words lie in a window found twice or more in their text, and which in one that stands before it too."""
    count = len(codes)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    base = np.uint64(0x9E3779B97F4A7C15)
    rolled = word_keys[codes]
    for step in range(1, lengths[0]):
        rolled = rolled[:-1] * base + word_keys[codes[step:]]
    starts = np.flatnonzero(np.arange(count) + lengths[0] <= ends)
    for length in lengths:
        if length > lengths[0]:
            rolled = rolled[:-1] * base + word_keys[codes[length - 1 :]]
            inside = np.zeros(count + 1, bool)
            inside[starts] = True
            starts = starts[inside[starts + 1]]
            starts = starts[starts + length <= ends[starts]]
        again = starts
        if len(starts):
            starts, again = repeated(codes, rolled, owner, starts, length)
        yield length, covered(starts, length, count), covered(again, length, count)


def repeated_lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text the number of lines with a word that equal an earlier line, and the characters of their words."""
    lists = pc.split_pattern(texts, "\n")
    lines, sizes = lists.flatten(), np.diff(np.asarray(lists.offsets, dtype=np.int64))
    owner = np.repeat(np.arange(len(texts)), sizes)
    chars = np.asarray(pc.subtract(pc.utf8_length(lines), pc.cast(pc.count_substring_regex(lines, BLANKS), pa.int64())), dtype=np.int64)
    filled = np.flatnonzero(chars > 0)
    owner, chars = owner[filled], chars[filled]
    codes, distinct = coded(lines.take(pa.array(filled)))
    keys = owner * max(len(distinct), 1) + codes
    first = np.unique(keys, return_index=True)[1]
    later = np.ones(len(keys), bool)
    later[first] = False
    owner = owner[later]
    return np.bincount(owner, minlength=len(texts)), np.bincount(owner, chars[later], len(texts)).astype(np.int64)


def measured(texts: pa.Array, lengths: range, base_window: int) -> dict[str, pa.Array]:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    words, sizes = split_words(texts)
    codes, distinct = coded(words)
    owner = np.repeat(np.arange(len(texts)), sizes)
    chars = np.asarray(pc.utf8_length(distinct), dtype=np.int64)[codes]
    total = lambda values: np.bincount(owner, values, len(texts)).astype(np.int64)
    repeat_words, grams = np.zeros(len(texts), np.int64), []
    if len(codes):
        for length, cover, again in gram_coverage(codes, word_hashes(distinct), sizes, lengths):
            grams.append(total(chars * again))
            if length == base_window:
                repeat_words = total(cover)
    else:
        grams = [repeat_words] * len(lengths)
    n_lines, line_chars = repeated_lines(texts)
    each = np.stack(grams, axis=1)
    return {
        "n_words": pa.array(sizes),
        "word_chars": pa.array(total(chars)),
        "n_symbols": pc.cast(pc.count_substring_regex(texts, SYMBOLS), pa.int64()),
        "n_dup_lines": pa.array(n_lines.astype(np.int64)),
        "dup_line_chars": pa.array(line_chars),
        "n_repeat_words": pa.array(repeat_words),
        "gram_chars": pa.ListArray.from_arrays(pa.array(np.arange(0, each.size + 1, len(lengths)), pa.int32()), pa.array(each.ravel())),
    }


def measure(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shares: Mapping[int, int] = GRAM_SHARES, base_window: int = BASE_WINDOW
) -> DataFrame:
    """One row per row: ``doc_id`` and the counts that :func:`judge` looks at.

    ``word_chars`` counts code points of words ``[^\\x20\\x09-\\x0D]+``; ``n_dup_lines`` lines with a word that equal an
    earlier line, and ``dup_line_chars`` the code points of their words; ``n_repeat_words`` the words in windows of
    ``base_window`` words that the text holds twice or more (all of them, the first included);
    ``gram_chars`` has, for each length in ``shares`` in ascending order, the code points of words in windows that stand
    earlier in the text already.

    A null text counts as empty, and an empty text has zeros. Rows with null or repeated ids are measured each by
    itself. Other columns are ignored. A text is measured whole in one task, with some 100 bytes a word.
    """
    lengths = range(min(shares), max(shares) + 1)
    if not min(shares) <= base_window <= max(shares):
        raise ValueError("the base window must lie between the shortest and the longest window")
    asked = [length - lengths[0] for length in sorted(shares)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", BATCH_BYTES):
            columns = measured(batch.column("text"), lengths, base_window)
            if len(asked) < len(lengths):
                each = np.asarray(columns["gram_chars"].values).reshape(-1, len(lengths))[:, asked]
                columns["gram_chars"] = pa.array(each.tolist(), pa.list_(pa.int64()))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), **columns})

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {MEASURES}")


def fails_base(fewest: int = FEWEST_WORDS, share: int = BASE_SHARE) -> Column:
    """Too few words, or too many of them in repeated windows; on the columns of :func:`measure`."""
    return (F.col("n_words") < fewest) | (100 * F.col("n_repeat_words") > share * F.col("n_words"))


def repeats_too_much(shares: Mapping[int, int] = GRAM_SHARES, line_share: int = LINE_SHARE) -> Column:
    """Whether repeated lines, or repeated windows of one of the lengths, hold more of the characters than they may."""
    over = 100 * F.col("dup_line_chars") > line_share * F.col("word_chars")
    for n, length in enumerate(sorted(shares)):
        over |= 100 * F.col("gram_chars")[n] > shares[length] * F.col("word_chars")
    return over


def judge(rows: DataFrame) -> DataFrame:
    """The rows of :func:`measure` with ``base_failed`` and ``kept``; all comparisons are of whole numbers."""
    failed = fails_base()
    return rows.select("*", failed.alias("base_failed"), (~failed & ~repeats_too_much()).alias("kept"))
