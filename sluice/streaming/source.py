"""Streams of JSON records from files or from a partitioned log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.readers import MICROS

# Names of the two start positions, as the log source calls them.
START = {"LATEST": "latest", "TRIM_HORIZON": "earliest"}


def file_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """New files below a path as a stream.

    A batch takes at most so many files, or files of at most so many bytes together (a larger file is a batch of its own).
    """
    if files_per_trigger and bytes_per_trigger:
        raise ValueError("a batch is limited by files or by bytes, not by both")
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt in ("json", "csv"):
        reader = reader.options(**MICROS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.load(path)


def log_stream(
    spark: SparkSession, servers: str, topic: str, start: str = "LATEST", records_per_trigger: int | None = None
) -> DataFrame:
    """A topic as a stream of key, text value, partition and arrival time.

    Needs the Kafka connector on the class path. Order holds within a key.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", START[start])
    )
    if records_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", records_per_trigger)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("record"), "partition", "timestamp"
    )


def json_fields(stream: DataFrame, schema: str, text: str = "record") -> DataFrame:
    """Records with a declared schema; a record that does not parse gives nulls."""
    return stream.withColumn("_r", F.from_json(text, schema)).select("_r.*")
