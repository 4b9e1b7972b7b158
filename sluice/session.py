"""Session profile and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job starts from. Sizes are per task, so they hold at any data volume.
PROFILE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.sql.session.timeZone": "UTC",
}


def tuned_session(
    app_name: str = "sluice",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or fetch) a session with the profile above.

    On a cluster set ``shuffle_partitions`` to a few times the core count; AQE merges what
    turns out to be small.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(PROFILE)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(extra or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def working_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    shared = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", shared)
    return shared


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the working folder; nothing is ever overwritten there."""
    return f"{working_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """Compute a DataFrame once and read it back from the shared folder from then on.

    For results that several later steps use. The copy outlives the executors that made it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(working_folder(df.sparkSession))
    return df.checkpoint()
