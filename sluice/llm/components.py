"""Connected components of an edge table, by spreading the smallest id and jumping along it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluice.session import scratch_path


def stored(df: DataFrame, name: str, used: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors.

    Its place is added to ``used``, for :func:`dropped` once nothing reads it any more.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    if used is not None:
        used.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, used: list[str]) -> None:
    """Remove tables that :func:`stored` wrote."""
    for path in used:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    used.clear()


def components(edges: DataFrame, used: list[str] | None = None) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``: the smallest id reachable from it.

    Every round each node takes the smallest label among its neighbours' and then the label of
    that label, so the number of rounds grows with the logarithm of the longest chain. A round is
    joins and a sum per node; all tables stay distributed.
    """
    edges = edges.where("a <> b").select("a", "b")
    both = stored(edges.union(edges.select("b", "a")).distinct(), "edges", used)
    labels = stored(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"), "labels", used)
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
            .withColumnRenamed("a", "node")
        )
        low = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        beyond = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        following = stored(low.join(beyond, "low").select("node", F.col("lower").alias("label"), F.col("label").alias("old")), "labels", used)
        labels = following.select("node", "label")
        if not following.where("label <> old").limit(1).count():
            return labels.select("node", F.col("label").alias("component"))
