"""One query per operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.llm import (
    dropout_bpe,
    language,
    licenses,
    near_dedup,
    nearest,
    packing,
    periodic,
    personal_data,
    pivot_codes,
    repetition,
    substring_dedup,
    vector_dedup,
    warc,
)
from sluice.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
win AS (
  SELECT doc_id, i, list_aggregate(words[i:i + 12], 'string_agg', ' ') AS window_text
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
late AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY window_text) AS first_doc FROM win)
  WHERE doc_id > first_doc),
gone AS (SELECT DISTINCT doc_id, i + d AS p FROM late, (SELECT unnest(range(0, 13)) AS d)),
lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
  sha256(coalesce(list_aggregate(
    list_transform(list_filter(range(1, len(words) + 1), lambda p: ps IS NULL OR NOT list_contains(ps, p)), lambda p: words[p]),
    'string_agg', ' '), '')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id)
"""


@query("op10_substring_dedup", OP10_SQL)
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [list_aggregate(words, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: list_aggregate(words[i:i + 2], 'string_agg', ' ')))
    END AS items
  FROM w),
sizes AS (SELECT doc_id, len(items) AS n FROM sets),
places AS (SELECT doc_id, unnest(items) AS item FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM places a JOIN places b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  WITH RECURSIVE r(a, b) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.a, s.b FROM r JOIN both_ways s ON r.b = s.a)
  SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN reach ON doc_id = a
"""


@query("op7_near_dedup", OP7_SQL)
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), words=3, similar=85)


@query("op4_language_id")
def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    kept_out = language.held_out()
    filters = language.fit(docs.where(~kept_out))
    return language.identify(docs.select("doc_id", "text"), filters).select("doc_id", kept_out.alias("held_out"), "lang_pred", "score")


@query("op8_packing")
def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op9_personal_data")
def op9_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = personal_data.find(docs, personal_data.fit(docs))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256)
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest.alias("base_sha256"), "spans")


OP6_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
FROM g
"""


@query("op6_warc", OP6_SQL)
def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.summary(warc.round_trip(table(spark, folder, "pages")))


@query("op1_license_scan")
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op3_merge_dropout")
def op3_merge_dropout(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the number and the checksum of its ids, and whether they decode to its text."""
    docs, model = table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    # The digest of the text goes along, so nothing is read twice or joined.
    own = docs.select("doc_id", "text", F.sha1(F.col("text").cast("binary")).alias("own"))
    encoded = dropout_bpe.encode(own, model, carry=["own"]).withColumn("n_tokens", F.size("ids").cast("long"))
    back = dropout_bpe.decode(encoded, model)
    same = F.sha1(F.col("text").cast("binary")).eqNullSafe(F.col("own"))
    return back.select("doc_id", "n_tokens", "ids_crc32", same.alias("lossless"))


@query("op2_nearest_neighbours")
def op2_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return nearest.search(rows, rows.where("vec_id % 50 = 0"))


@query("op5_vector_dedup")
def op5_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, folder, "embeddings"))


OP11_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM t),
places AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w),
chars AS (SELECT doc_id, sum(length(word)) AS word_chars FROM places GROUP BY doc_id),
win AS (
  SELECT doc_id, n, i, list_aggregate(words[i:i + n - 1], 'string_agg', ' ') AS gram
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM w, (SELECT unnest(range(5, 11)) AS n))),
twice AS (
  SELECT doc_id, n, i, i > min(i) OVER (PARTITION BY doc_id, n, gram) AS again
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, n, gram) AS times FROM win) WHERE times > 1),
inside AS (
  SELECT doc_id, n, i + d AS i, bool_or(again) AS again
  FROM twice, (SELECT unnest(range(0, 10)) AS d) WHERE d < n GROUP BY ALL),
grams AS (
  SELECT doc_id, count(*) FILTER (n = 8) AS n_repeat_words,
    coalesce(sum(length(word)) FILTER (again AND n = 5), 0) AS c5, coalesce(sum(length(word)) FILTER (again AND n = 6), 0) AS c6,
    coalesce(sum(length(word)) FILTER (again AND n = 7), 0) AS c7, coalesce(sum(length(word)) FILTER (again AND n = 8), 0) AS c8,
    coalesce(sum(length(word)) FILTER (again AND n = 9), 0) AS c9, coalesce(sum(length(word)) FILTER (again AND n = 10), 0) AS c10
  FROM inside JOIN places USING (doc_id, i) GROUP BY doc_id),
lines AS (SELECT doc_id, line, count(*) AS times, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS size
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t) GROUP BY doc_id, line),
more AS (SELECT doc_id, sum(times - 1) AS n_dup_lines, sum((times - 1) * size) AS line_chars FROM lines WHERE size > 0 GROUP BY doc_id),
all_counts AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(line_chars, 0) AS line_chars, coalesce(c5, 0) AS c5, coalesce(c6, 0) AS c6, coalesce(c7, 0) AS c7,
    coalesce(c8, 0) AS c8, coalesce(c9, 0) AS c9, coalesce(c10, 0) AS c10
  FROM w LEFT JOIN chars USING (doc_id) LEFT JOIN grams USING (doc_id) LEFT JOIN more USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 100 * line_chars > 20 * word_chars
    OR 100 * c5 > 15 * word_chars OR 100 * c6 > 14 * word_chars OR 100 * c7 > 13 * word_chars
    OR 100 * c8 > 12 * word_chars OR 100 * c9 > 11 * word_chars OR 100 * c10 > 10 * word_chars) AS kept
FROM all_counts
"""


@query("op11_repetition", OP11_SQL)
def op11_repetition(spark: SparkSession, folder: str) -> DataFrame:
    judged = repetition.judge(repetition.measure(table(spark, folder, "documents")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, repeats a stretch of its words up to its end."""
    check = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n, g = F.size(words), F.floor(check / 10)
    first = (g % n).cast("int")
    period = (1 + F.floor((n - first) / (3 + g % 8))).cast("int")
    times = F.ceil((n - first) / period).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, first + 1, period), times)), F.lit(1), n - first)
    changed = F.concat_ws(" ", F.slice(words, F.lit(1), first), tail)
    return docs.select("doc_id", F.when((check % 10 == 0) & (n > 0), changed).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.periodic_runs(with_planted_runs(table(spark, folder, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.period")).alias("exponent_milli"),
        digest(F.array_join(listed, "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


def op13_sql(rounds: int = 4) -> str:
    """Each round is an assignment and the means of what was assigned."""
    assigned = """
a{0} AS (
  SELECT vec_id, part, min(d * 256 + entry) % 256 AS entry, min(d * 256 + entry) // 256 AS d
  FROM (SELECT vec_id, p.part, entry,
      CAST(list_sum(list_transform(list_zip(p.v, b.v), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS BIGINT) AS d
    FROM p JOIN b{0} b ON p.part = b.part)
  GROUP BY vec_id, part)"""
    means = """
b{1} AS (
  SELECT part, entry, coalesce(m.v, b.v) AS v FROM b{0} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY i) AS v FROM (
      SELECT part, entry, i, CAST(floor(sum(c) / count(*)) AS BIGINT) AS mean
      FROM (SELECT a.part, a.entry, unnest(p.v) AS c, unnest(range(len(p.v))) AS i FROM a{0} a JOIN p USING (vec_id, part))
      GROUP BY part, entry, i) GROUP BY part, entry) m USING (part, entry))"""
    steps = [assigned.format(r) + "," + means.format(r, r + 1) for r in range(rounds)]
    return f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT vec_id, CAST(part AS BIGINT) AS part, x[part * len(x) // 4 + 1:(part + 1) * len(x) // 4] AS v FROM k, (SELECT unnest(range(4)) AS part)),
b0 AS (
  SELECT part, entry, v FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM k ORDER BY vec_id LIMIT 256) USING (vec_id)),
{",".join(steps)},
{assigned.format(rounds)},
codes AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id),
sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM codes JOIN k USING (vec_id) GROUP BY label),
books AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM k JOIN codes USING (vec_id) JOIN sums ON k.label IS NOT DISTINCT FROM sums.label, books
"""


@query("op13_pivot_codes", op13_sql())
def op13_pivot_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = pivot_codes.compress(table(spark, folder, "embeddings"))
    digest = F.lit(pivot_codes.codebook_digest(books)).alias("codebooks_sha256")
    return coded.select("vec_id", "code", "error", "label_error", digest)
