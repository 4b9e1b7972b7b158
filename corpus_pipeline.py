"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything its predecessor kept. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import language, near_dedup, packing, personal_data, substring_dedup
from sluice.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text of whose n-grams the best language has less than this share is in none of them. At 1 to 40 languages (those of sf0.1
# and enciphered ones) samples of held-out documents had 0.371 or more, random letters and base64 0.086 or less.
LEAST_EVIDENCE = 0.2
# Bytes that travel to a Python worker at once; Spark's 64 MB would be held by both sides beside the work itself.
BATCH_BYTES = 4 << 20


def small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage with small batches between Spark and its Python workers."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter (or null), and texts in none of the learned languages, go."""
    filters = language.fit(docs.where(~language.held_out()))
    told = language.identify(docs.select(*COLUMNS), filters, evidence="evidence")
    if filters is None:  # nothing to learn from, so nothing to reject by
        return docs.select(*COLUMNS)
    return told.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("evidence") >= LEAST_EVIDENCE)).select(*COLUMNS)


@small_batches
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Rows that share an id are one document and stay or go together; rows without an id stay.
    """
    gone = near_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


@small_batches
def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that an earlier document has are cut; other texts stay as they are."""
    cut = substring_dedup.remove_repeats(docs, carry=("lang", "source"), verbatim=True)
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", sized("kept_text", docs)).select(*COLUMNS)


@small_batches
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by the name of its kind."""
    clean = personal_data.redact(docs.select(*COLUMNS), personal_data.fit(docs))
    return clean.withColumn("n_chars", sized("text", docs)).select(*COLUMNS)


@small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 4096."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def sized(text: str, docs: DataFrame):
    return F.length(text).cast(docs.schema["n_chars"].dataType).alias("n_chars")


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_near_copies),
    ("substring_dedup", without_repeated_passages),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

# SQL has neither the models nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
