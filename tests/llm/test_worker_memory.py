"""What a Python worker holds beside the texts of a batch."""

from __future__ import annotations

import random
import tracemalloc

import public_tokenizers
import pyarrow as pa

from sluice.llm import packing, substring_dedup


def varied_texts(count: int, words: int) -> list[str]:
    draw, letters = random.Random(3), str.maketrans("0123456789", "abcdefghij")
    return [" ".join(f"{draw.randrange(100_000):07d}" for _ in range(words)).translate(letters) for _ in range(count)]


def test_repeats_of_a_batch_need_little_beside_its_words(spark, monkeypatch):
    texts = varied_texts(1000, 500)
    given, docs = [], spark.createDataFrame([(1, "a")], "doc_id long, text string")
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, fn, *rest: given.append(fn) or real(self, fn, *rest))
    monkeypatch.setattr(substring_dedup, "frequent", lambda *rest: ([], 500_000))
    substring_dedup.repeated_spans(docs, False)
    batch = pa.record_batch({"doc_id": pa.array(range(1000), pa.int64()), "text": pa.array(texts)})
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in given[0](iter([batch]))) > 0
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 130 * 500_000


def test_the_tokenizer_is_given_few_words_at_once():
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), 2)
    texts, given, tokenizer = pa.array(varied_texts(400, 500)), [], encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, batch, **options):
            given.append(sum(map(len, batch)))
            return tokenizer.encode_batch_fast(batch, **options)

    encoder.tokenizer = Counted()
    got = encoder(texts)
    assert [g.tolist() for g in got] == [[*e.ids, 2] for e in tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
    assert max(given) < 300_000 < sum(given)
