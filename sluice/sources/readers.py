"""Reading files of the lake."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.times import LAYOUTS
from sluice.schemas import record_schema

# Fixed value: text formats keep microseconds only when told to, on both sides.
MICROS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}

# Quotes inside of quoted fields are doubled, on both sides.
CSV = {**MICROS, "header": "true", "quote": '"', "escape": '"'}


def load(spark: SparkSession, path: str, schema_name: str, fmt: str = "parquet", multiline: bool = True) -> DataFrame:
    """Read files with a registered schema.

    A multi-line JSON file cannot be split, so write large JSON data one record per line and
    read it with ``multiline=False``.
    """
    schema = record_schema(schema_name)
    reader = spark.read.schema(schema)
    match fmt.lower():
        case "parquet":
            return reader.parquet(path)
        case "orc":
            return reader.orc(path)
        case "json":
            return reader.options(**MICROS).option("multiLine", multiline).json(path)
        case "csv":
            return reader.options(**CSV).csv(path)
    raise ValueError(f"unsupported format {fmt!r}")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of one schema; footers are not merged."""
    return spark.read.option("mergeSchema", "false").parquet(*paths)


def read_json_lines(spark: SparkSession, path: str | Sequence[str], schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).options(**MICROS).option("multiLine", False).json(path)


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV).csv(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.orc(path)


def read_partitioned(
    spark: SparkSession, root: str, schema: str, fmt: str = "json", granularity: str = "hour"
) -> DataFrame:
    """A Hive-style tree with its folder columns as zero-padded text.

    Filters on the folder columns decide which folders are listed and read.
    """
    folders = ", ".join(f"{name} STRING" for name, _ in LAYOUTS[granularity])
    reader = spark.read.schema(f"{schema}, {folders}").option("basePath", root).format(fmt)
    return reader.options(**MICROS).load(root)


def folder_number(name: str) -> Column:
    """Value of a ``name=...`` folder in the path of the file a row came from."""
    return F.regexp_extract(F.col("_metadata.file_path"), f"{name}=([0-9]+)", 1).try_cast("int")


def with_path_columns(df: DataFrame, granularity: str = "hour") -> DataFrame:
    """Folder values from the file path, for files read without their root.

    Such columns are computed per row and prune nothing; prefer :func:`read_partitioned`.
    """
    return df.select("*", *[folder_number(name).alias(name) for name, _ in LAYOUTS[granularity]])
