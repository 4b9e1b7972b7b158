"""Named data sets held in memory, refreshed when their files change."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

# Under which name of the session the version of a data set is kept.
VERSION = "sluice.dataset."


def files_version(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and times of the files below a path. Folders and hidden files do not count."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found, digest = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True), hashlib.sha256()
    lines = []
    while found.hasNext():
        f = found.next()
        if f.getPath().getName()[:1] not in "._":
            lines.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}\n")
    for line in sorted(lines):
        digest.update(line.encode())
    return digest.hexdigest()


def in_memory(spark: SparkSession, name: str, path: str, fmt: str = "parquet", schema: str | None = None) -> DataFrame:
    """The data set as the view ``name``, cached by the executors (on disk where memory is short).

    The files are looked at, not read, at every call: while they are the same, the cached rows answer; when one was added, removed
    or replaced, the data set is read anew. Cached rows of lost executors are read again by Spark.
    """
    version, known = files_version(spark, path), spark.conf.get(VERSION + name, None)
    if known == f"{path} {version}" and spark.catalog.tableExists(name) and spark.catalog.isCached(name):
        return spark.table(name)
    release(spark, name)
    reader = spark.read.format(fmt)
    (reader.schema(schema) if schema else reader).load(path).createOrReplaceTempView(name)
    spark.catalog.cacheTable(name)
    spark.conf.set(VERSION + name, f"{path} {version}")
    return spark.table(name)


def release(spark: SparkSession, name: str) -> None:
    """Forget a data set and free its memory."""
    if spark.catalog.tableExists(name):
        if spark.catalog.isCached(name):
            spark.catalog.uncacheTable(name)
        spark.catalog.dropTempView(name)
    spark.conf.unset(VERSION + name)
