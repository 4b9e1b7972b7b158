"""Personal data: exact patterns, widened by a skip-chain conditional random field.

The patterns find e-mail addresses, IPv4 addresses, card and phone numbers. The random field
labels the tokens that hold a digit or an @; every other token is outside. Neighbouring tokens
share a potential, and so do repeated or similar tokens anywhere in the document (each is tied to
the one before it, which makes chains that skip the text between), so a number that is clear at one place
is found at the others too. Beliefs come from loopy message passing. What it labels with a high
belief, outside the spans of the patterns, is added.

The weights are learned by pseudo-likelihood from a bounded sample of documents, in which the
patterns and a few written forms of phone numbers give the labels, and the features describe
the shape of a token and not the patterns.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sluice.llm.words import chunks

KINDS = ("email", "ip", "card", "phone")
# The bounds of the fit: documents with a token to label, tokens of each, and characters of a token. Then the least belief of an added span.
SAMPLE_DOCS, SAMPLE_TOKENS, SAMPLE_CHARS, BELIEF = 3000, 64, 200, 0.9
FEATURES = 1 << 12
# Messages have settled when none changes by more; as loops can swing for ever, no text gets more rounds than it has tokens, and these.
SETTLED, SPARE_ROUNDS = 1e-4, 200

LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit before the match would have begun it; runs of digits give nothing back.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
ACTIVE = re.compile(r"[0-9@]")
BLANK = re.compile(r"[\x20\x09-\x0D]")
# Written forms of phone numbers without a country code, for training labels only.
WRITTEN_PHONE = re.compile(r"(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9])")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(divmod(2 * int(d), 10)[0] + 2 * int(d) % 10 for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the local part, an @ and the domain, in one pass over the @ signs."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in LOCAL_CHARS:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            free = domain.end()
            out.append((begin, free))
        # The part before an @ cannot reach over the @ before it.
        free = max(free, at + 1) if not domain else free
        at = text.find("@", max(at + 1, free))
    return out


def exact_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the patterns, by kind and start; matches that fail their test are dropped."""
    out = [(0, a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


def active_tokens(text: str) -> list[tuple[int, int]]:
    """Start and end of the tokens with a digit or an @."""
    out, end = [], 0
    for m in ACTIVE.finditer(text):
        if m.start() < end:
            continue
        begin = m.start()
        while begin > end and text[begin - 1] not in " \t\n\x0b\x0c\r":
            begin -= 1
        blank = BLANK.search(text, m.end())
        end = blank.start() if blank else len(text)
        out.append((begin, end))
    return out


DIGITS, LETTERS = re.compile(r"[0-9]+"), re.compile(r"[^\W\d_]+")


def shape(token: str) -> str:
    """Runs of letters as ``a``, runs of digits as their length, the rest as it is."""
    return DIGITS.sub(lambda m: str(min(len(m[0]), 20)), LETTERS.sub("a", token))


def slot(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


class Graph:
    """The active tokens of several texts, their features, and the pairs that share a potential."""

    def __init__(self, texts: list[str | None]):
        self.spans, self.owner, features, near, far = [], [], [], [], []
        for n, text in enumerate(texts):
            last: dict[str, int] = {}
            before, before_end = None, None
            for a, b in active_tokens(text or ""):
                token, here = text[a:b], len(self.spans)
                core = token.strip("#$%&*!,;:.\"'")
                form = shape(core)
                next_to = before is not None and BLANK.sub("", text[before_end:a]) == "" and a - before_end <= 2
                own = [f"shape {form}", f"digits {min(sum(map(str.isdigit, core)), 20)}", f"at {'@' in core}", f"letters {'a' in form}", f"open {core[:1] == '('}", f"dots {min(core.count('.'), 4)}"]
                features.append([slot(x) for x in own] + [slot(f"before {before if next_to else ''}")])
                if next_to:
                    near.append((here - 1, here))
                keys = {core, form} if sum(map(str.isdigit, core)) >= 6 or "@" in core else {core}
                for key in keys:
                    if key in last:
                        far.append((last[key], here))
                    last[key] = here
                before, before_end = form, b
                self.spans.append((a, b))
                self.owner.append(n)
        self.features = np.array(features, np.int64).reshape(-1, 7)
        self.near = np.array(near, np.int64).reshape(-1, 2)
        self.far = np.array(sorted(set(far)), np.int64).reshape(-1, 2)


class Field:
    """Weights of features per label, of neighbours, and of repeated or similar tokens."""

    def __init__(self, unary: np.ndarray, near: np.ndarray, far: np.ndarray):
        self.unary, self.near, self.far = unary, near, far

    @classmethod
    def fit(cls, graph: Graph, labels: np.ndarray, steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> Field:
        """Maximise the probability of each label given its neighbours' labels."""
        count, tokens = len(KINDS) + 1, len(labels)
        w, near, far = np.zeros((FEATURES, count)), np.zeros((count, count)), np.zeros((count, count))
        sums = [np.full_like(x, 1e-8) for x in (w, near, far)]
        hot = np.eye(count)[labels]
        for _ in range(steps):
            score = w[graph.features].sum(axis=1)
            for edges, t in ((graph.near, near), (graph.far, far)):
                np.add.at(score, edges[:, 1], t[labels[edges[:, 0]]])
                np.add.at(score, edges[:, 0], t.T[labels[edges[:, 1]]])
            p = np.exp(score - score.max(axis=1, keepdims=True))
            error = hot - p / p.sum(axis=1, keepdims=True)
            g = np.zeros_like(w)
            np.add.at(g, graph.features.ravel(), np.repeat(error, graph.features.shape[1], axis=0))
            steps_ = [g]
            for edges in (graph.near, graph.far):
                t = np.zeros((count, count))
                np.add.at(t, labels[edges[:, 0]], error[edges[:, 1]])
                np.add.at(t.T, labels[edges[:, 1]], error[edges[:, 0]])
                steps_.append(t)
            for x, d, s in zip((w, near, far), steps_, sums):
                d = d / max(tokens, 1) - decay * x
                s += d * d
                x += rate * d / np.sqrt(s)
        return cls(w, near, far)

    def beliefs(self, graph: Graph) -> np.ndarray:
        """Label probabilities by loopy message passing."""
        own = self.unary[graph.features].sum(axis=1)
        source = np.concatenate([graph.near[:, 0], graph.near[:, 1], graph.far[:, 0], graph.far[:, 1]])
        target = np.concatenate([graph.near[:, 1], graph.near[:, 0], graph.far[:, 1], graph.far[:, 0]])
        pair = np.concatenate(
            [np.broadcast_to(t, (len(e), *t.shape)) for e, t in ((graph.near, self.near), (graph.near, self.near.T), (graph.far, self.far), (graph.far, self.far.T))]
        )
        half = [len(graph.near), len(graph.near), len(graph.far), len(graph.far)]
        start = np.cumsum([0, *half])
        back = np.concatenate([np.arange(start[k], start[k + 1]) for k in (1, 0, 3, 2)])
        message, belief = np.zeros((len(source), own.shape[1])), own.copy()
        owner = np.array(graph.owner, np.int64)
        limit = SPARE_ROUNDS + (np.bincount(owner) if len(owner) else np.zeros(0, np.int64))
        active, rounds = np.arange(len(source)), 0
        while len(active):  # texts whose messages have settled drop out
            out = belief[source[active]] - message[back[active]]
            out = out[:, :, None] + pair[active]
            top = out.max(axis=1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            new = 0.5 * message[active] + 0.5 * new
            moved = np.abs(new - message[active]).max(axis=1) > SETTLED
            message[active] = new
            texts = np.zeros(len(limit), bool)
            texts[owner[source[active]]] = True
            of_active = texts[owner]
            belief[of_active] = own[of_active]
            np.add.at(belief, target[active], message[active])
            rounds += 1
            goes_on = np.zeros(len(limit), bool)
            goes_on[owner[source[active[moved]]]] = True
            active = active[(goes_on & (rounds < limit))[owner[source[active]]]]
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def weak_labels(text: str, tokens: list[tuple[int, int]]) -> list[int]:
    marked = [(k, a, b) for k, a, b in exact_spans(text)] + [(3, *m.span()) for m in WRITTEN_PHONE.finditer(text)]
    out = []
    for a, b in tokens:
        out.append(next((k + 1 for k, x, y in marked if x < b and a < y), 0))
    return out


def fit(
    docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_tokens: int = SAMPLE_TOKENS, sample_chars: int = SAMPLE_CHARS
) -> Field:
    """Learn from at most ``sample_docs`` documents that have a token to label: those with the smallest hashes of their texts.

    Of each only the tokens around digits and @ signs travel, with as much text as they need: ``sample_tokens`` of them that follow each
    other, from a place chosen by the hash, so that late parts of long documents are learned from too; tokens of more than
    ``sample_chars`` characters stand for a word. These bounds hold for the fit alone. Null and empty texts give nothing to learn;
    equal texts count once; other columns are ignored; without any token the field labels nothing.
    """

    def gist(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            hashes, lines = [], []
            for value in batch.column("text").to_pylist():
                tokens = active_tokens(value)
                if tokens:
                    chosen = zlib.crc32(value.encode("utf-8", "surrogatepass"))
                    hashes.append(chosen)
                    first = chosen % (max(0, len(tokens) - sample_tokens) + 1)
                    tokens = tokens[first : first + sample_tokens]
                    # Tokens that are not neighbours are kept apart by a word.
                    parts = [value[tokens[0][0] : tokens[0][1]]]
                    for (_, b), (c, d) in zip(tokens, tokens[1:]):
                        between = value[b:c]
                        parts += [between if between.strip() == "" and len(between) <= sample_chars else " x ", value[c:d]]
                    lines.append("".join(p if len(p) <= sample_chars else " x " for p in parts))
            yield pa.record_batch({"rank": pa.array(hashes, pa.int64()), "line": pa.array(lines, pa.string())})

    sample = docs.select(F.col(text).cast("string").alias("text")).where("text rlike '[0-9@]'").mapInArrow(gist, "rank long, line string")
    lines = [r["line"] for r in sample.distinct().orderBy("rank", "line").limit(sample_docs).collect()]
    graph = Graph(lines)
    labels: list[int] = []
    for line in lines:
        labels += weak_labels(line, active_tokens(line))
    return Field.fit(graph, np.array(labels, np.int64))


class Taken:
    """Spans by their starts, to be asked for any that overlaps another."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        ordered = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in ordered]
        self.reach = list(itertools.accumulate((b for _, b in ordered), max))

    def meets(self, a: int, b: int) -> bool:
        before = bisect.bisect_left(self.starts, b)
        return before > 0 and self.reach[before - 1] > a


def all_spans(texts: list[str | None], field: Field, belief: float = BELIEF) -> list[tuple[list, list]]:
    """Per text the spans of the patterns, and these with the added ones."""
    exact = [exact_spans(t) if t else [] for t in texts]
    graph = Graph(texts)
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    taken = [Taken(spans) for spans in exact]
    if graph.spans:
        p = field.beliefs(graph)
        label, sure = p.argmax(axis=1), p.max(axis=1) >= belief
        joined = set(map(tuple, graph.near.tolist()))
        n = 0
        while n < len(label):
            m = n + 1
            if label[n] and sure[n]:
                while m < len(label) and label[m] == label[n] and sure[m] and (m - 1, m) in joined and label[n] == 4:
                    m += 1
                d = graph.owner[n]
                a, b = graph.spans[n][0], graph.spans[m - 1][1]
                text = texts[d]
                while a < b and not (text[a].isalnum() or text[a] in "+("):
                    a += 1
                while a < b and not text[b - 1].isalnum():
                    b -= 1
                if a < b and not taken[d].meets(a, b):
                    added[d].append((int(label[n]) - 1, a, b))
            n = m
    return [(e, sorted(e + x)) for e, x in zip(exact, added)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, field: Field, text: str = "text", belief: float = BELIEF) -> DataFrame:
    """``docs`` with ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_spans`` and ``spans``.

    Spans are written ``kind:start:end``, comma-joined, by kind in that order, then start; places are code points,
    the end is exclusive. The counts are those of the patterns alone. A null or empty text has
    none. Columns of these names are replaced, all others pass.
    """
    names = [*(f"n_{k}" for k in KINDS), "base_spans", "spans"]
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            found = all_spans(batch.column(text).to_pylist(), shared.value, belief)
            for n, kind in enumerate(KINDS):
                batch = batch.append_column(f"n_{kind}", pa.array([sum(k == n for k, _, _ in base) for base, _ in found], pa.int64()))
            batch = batch.append_column("base_spans", pa.array([written(base) for base, _ in found], pa.string()))
            yield batch.append_column("spans", pa.array([written(every) for _, every in found], pa.string()))

    kinds = [T.StructField(n, T.LongType() if n[:2] == "n_" else T.StringType()) for n in names]
    return docs.mapInArrow(search, T.StructType([*docs.schema.fields, *kinds]))


def masked(text: str | None, spans: str) -> str | None:
    """The text with every span replaced by the name of its kind; of spans that overlap, the union goes."""
    if not spans:
        return text
    out, done = [], 0
    for a, b, kind in sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(","))):
        if a >= done:
            out += [text[done:a], f"[{kind}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, field: Field, text: str = "text", belief: float = BELIEF) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by the name of its kind in brackets.

    A null or empty text stays as it is. Every row is worked on by itself, so rows with null or repeated ids are as well; all other
    columns pass, whatever their names. A text is held whole in one task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text):
            texts = batch.column(text).to_pylist()
            clean = [masked(t, written(every)) for t, (_, every) in zip(texts, all_spans(texts, shared.value, belief))]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(clean, batch.schema.field(at).type))

    return docs.mapInArrow(cover, docs.schema)
