"""Writing files of the lake, and comparing formats."""

from __future__ import annotations

import time
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.functions.times import LAYOUTS, partition_columns
from sluice.functions.values import rows
from sluice.session import settled
from sluice.sources.readers import CSV, MICROS

# The codec for each use, and the codecs of the comparison.
CODEC_POLICY = {"realtime": "snappy", "batch": "gzip", "archive": "bzip2"}
PARQUET_CODECS = ("snappy", "gzip", "lz4", "zstd")
TEXT_ONLY_CODECS = {"bzip2"}


def write_partitioned(
    df: DataFrame, path: str, ts: str, granularity: str = "hour", fmt: str = "json", mode: str = "append"
) -> None:
    """Files below time folders such as ``year=2024/month=01``.

    Rows are brought together by folder so that few files result; the rebalance hint lets
    Spark split a folder that is too large for one task.
    """
    names = [name for name, _ in LAYOUTS[granularity]]
    placed = df.withColumns(partition_columns(ts, granularity)).hint("rebalance", *names)
    placed.write.mode(mode).options(**MICROS).partitionBy(*names).format(fmt).save(path)


def write_parquet(
    df: DataFrame, path: str, files: int | None = None, partition_by: tuple[str, ...] = (), mode: str = "overwrite"
) -> None:
    """Parquet output; ``files`` merges small results and should follow the result's size.

    The rows are dealt anew for it, so what comes before keeps its parallelism.
    """
    out = df.repartition(files) if files else df
    writer = out.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_by_region(df: DataFrame, path: str, ts: str, region: str) -> None:
    """Time and category folders: year, month, region."""
    placed = df.withColumns(partition_columns(ts, "month")).hint("rebalance", "year", "month", region)
    placed.write.mode("append").partitionBy("year", "month", region).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace just the folders the data touches, so a rerun of one hour leaves the rest alone."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_for(df: DataFrame, path: str, use: str, fmt: str = "parquet") -> None:
    """Write with the codec of the policy; codecs Parquet does not know need a text format."""
    codec = CODEC_POLICY[use]
    if codec in TEXT_ONLY_CODECS and fmt not in ("json", "csv", "text"):
        raise ValueError(f"{codec} can compress text formats only, not {fmt}")
    options = {"json": MICROS, "csv": CSV}.get(fmt, {})
    df.write.mode("errorifexists").options(**options).option("compression", codec).format(fmt).save(path)


def write_split(good: DataFrame, bad: DataFrame, good_path: str, bad_path: str) -> None:
    """Good records and dead letters to separate places."""
    good.write.mode("append").parquet(good_path)
    bad.write.mode("append").options(**MICROS).json(bad_path)


def write_with_metadata(df: DataFrame, path: str, processed_at: Column) -> DataFrame:
    """Write a table and return one row on the run: record count, time and place.

    The count is observed while the rows are written, without a second pass.
    """
    seen = Observation()
    df.observe(seen, rows().alias("total_records")).write.mode("errorifexists").parquet(path)
    return df.sparkSession.range(1).select(
        F.lit(seen.get["total_records"]).alias("total_records"),
        processed_at.alias("processing_timestamp"),
        F.lit(path).alias("output_path"),
    )


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below a path, asked of the file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getContentSummary(target).getLength()


def codec_sizes(df: DataFrame, root: str, codecs: tuple[str, ...] = PARQUET_CODECS) -> DataFrame:
    """Write a table once per codec and report the bytes."""
    spark, out = df.sparkSession, []
    for codec in codecs:
        df.write.option("compression", codec).parquet(f"{root}/{codec}")
        out.append((codec, path_bytes(spark, f"{root}/{codec}")))
    return spark.createDataFrame(out, "codec STRING, bytes BIGINT")


# The layouts compared, as name -> (format, codec).
COMPARED = {
    "csv": ("csv", "none"),
    "json": ("json", "none"),
    "parquet_snappy": ("parquet", "snappy"),
    "parquet_gzip": ("parquet", "gzip"),
    "orc": ("orc", "snappy"),
}


def json_to_parquet(spark: SparkSession, raw: str, schema: str, columnar: str, errors: str) -> None:
    """Rewrite JSON lines as Parquet; lines that do not fit the schema go to ``errors`` as they are."""
    checked = spark.read.schema(f"{schema}, _bad STRING").option("columnNameOfCorruptRecord", "_bad").json(raw)
    checked = settled(checked)  # both parts come from one parse
    checked.filter("_bad IS NULL").drop("_bad").write.parquet(columnar)
    checked.filter("_bad IS NOT NULL").select("_bad").write.text(errors)


def write_formats(df: DataFrame, root: str, wanted: Collection[str] | None = None) -> dict[str, tuple[str, float]]:
    """One copy of a table per wanted layout: name -> (path, seconds to write)."""
    out = {}
    for name in wanted or COMPARED:
        fmt, codec = COMPARED[name]
        writer = df.write.option("compression", codec).format(fmt)
        if fmt in ("csv", "json"):
            writer = writer.options(**(CSV if fmt == "csv" else MICROS))
        started = time.perf_counter()
        writer.save(f"{root}/{name}")
        out[name] = (f"{root}/{name}", time.perf_counter() - started)
    return out


def read_format(spark: SparkSession, name: str, path: str, schema) -> DataFrame:
    fmt = COMPARED[name][0]
    reader = spark.read.schema(schema)
    if fmt in ("csv", "json"):
        reader = reader.options(**(CSV if fmt == "csv" else MICROS))
    return reader.format(fmt).load(path)


def format_report(df: DataFrame, root: str) -> DataFrame:
    """Size, saving against CSV, write and read time per format; row counts must agree."""
    spark, schema = df.sparkSession, df.schema
    written = write_formats(df, root)
    base = path_bytes(spark, written["csv"][0])
    out, counts = [], set()
    for name, (path, write_seconds) in written.items():
        started = time.perf_counter()
        count = read_format(spark, name, path, schema).count()
        size = path_bytes(spark, path)
        out.append((name, size, (1 - size / base) * 100, write_seconds, time.perf_counter() - started, count))
        counts.add(count)
    if len(counts) != 1:
        raise ValueError(f"row counts differ between formats: {out}")
    columns = "format STRING, bytes BIGINT, saved_percent DOUBLE, write_seconds DOUBLE, read_seconds DOUBLE, rows BIGINT"
    return spark.createDataFrame(out, columns)


def index_documents(df: DataFrame, at: str, processed_at: Column, processed_by: str) -> DataFrame:
    """Rows as JSON documents with an id, ready for a search index."""
    doc_id = F.concat_ws("_", F.coalesce("event_type", F.lit("unknown")), F.unix_timestamp(at).cast("string"))
    body = F.struct("*", processed_at.alias("@timestamp"), F.lit(processed_by).alias("processed_by"))
    return df.select(doc_id.alias("_id"), F.to_json(body).alias("document"))
