"""Rows of a stream that no late row can change any more, handed on once with the rows before them.

Windows and sums have state inside of Spark. What looks at single rows in their order (a moving frame of rows, the
path of a session) cannot keep them as state of one key, as a busy key would fill one task. So every batch is
stored by hours of event time. When the watermark moves on, the rows it has passed are *closed*: they are read back
together with a stretch before them, and the table form of the operator runs over just these, spread as it likes.

A batch that comes again after a failure finds the same watermark and replaces what it wrote. Rows behind
the watermark are stored apart with their delay. Hours that no later batch can need are removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sluice.streaming.sinks import each_batch

MICROS_PER_SECOND, MICROS_PER_HOUR = 1_000_000, 3_600_000_000
OWN, LATE_BY = "is_closed_now", "late_us"
PLACES = "late BOOLEAN, hour BIGINT, batch BIGINT"


def closed_batches(
    stream: DataFrame,
    ts: str,
    store: str,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    delay_seconds: int = 5,
    unit_seconds: float = 1e-6,
    lookback_seconds: int = 0,
    every: str | None = None,
) -> StreamingQuery:
    """Call ``work`` per batch with the rows that are closed by it.

    The watermark stands ``delay_seconds`` behind the latest time seen, rounded down to ``unit_seconds`` since
    1970, so whole windows close. ``work`` gets the closed rows, and those of up to ``lookback_seconds`` before
    them, told apart by ``is_closed_now``. Rows that come behind the watermark, or without a time, are late: they are
    left out and can be read with :func:`late_rows`.
    """
    unit, lookback = max(1, round(unit_seconds * MICROS_PER_SECOND)), lookback_seconds * MICROS_PER_SECOND
    us = F.unix_micros(F.col(ts).cast("timestamp"))

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = mark(spark, store, batch_id - 1)
        late_by = F.lit(before) - us if before is not None else F.lit(None).cast("bigint")
        late = us.isNull() | F.coalesce(late_by > 0, F.lit(False))
        placed = batch.withColumns(
            {LATE_BY: F.when(late, late_by), "late": late, "hour": F.floor(us / MICROS_PER_HOUR), "batch": F.lit(batch_id).cast("bigint")}
        )
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("late", "hour", "batch").parquet(f"{store}/rows")
        stored = stored_rows(spark, store, batch).filter(~F.col("late") & (F.col("batch") <= batch_id))
        top = stored.filter(F.col("batch") == batch_id).agg(F.max(us)).first()[0]
        after = before if top is None else max((top - delay_seconds * MICROS_PER_SECOND) // unit * unit, before if before is not None else -(2**62))
        put_mark(spark, store, batch_id, after)
        if after is None:
            return
        needed = stored.filter((F.col("hour") <= after // MICROS_PER_HOUR) & (us < after))
        if before is not None:
            needed = needed.filter((F.col("hour") >= (before - lookback) // MICROS_PER_HOUR) & (us >= before - lookback))
        own = us >= before if before is not None else F.lit(True)
        work(needed.withColumn(OWN, own).drop(LATE_BY, "late", "hour", "batch"), batch_id)
        if before is not None:
            forget(spark, store, (before - lookback) // MICROS_PER_HOUR)

    return each_batch(stream, run, checkpoint, every)


def stored_rows(spark: SparkSession, store: str, like: DataFrame) -> DataFrame:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields)
    return spark.read.schema(f"{columns}, {LATE_BY} BIGINT, {PLACES}").parquet(f"{store}/rows")


def late_rows(spark: SparkSession, store: str, like: DataFrame) -> DataFrame:
    """The rows that came too late, with the microseconds by which they did (null without a time) and the batch they came in."""
    return stored_rows(spark, store, like).filter("late").drop("late", "hour")


def mark(spark: SparkSession, store: str, batch_id: int) -> int | None:
    """The watermark after a batch, in microseconds."""
    if batch_id < 0:
        return None
    return spark.read.schema("mark BIGINT").parquet(f"{store}/marks/batch={batch_id}").first()[0]


def put_mark(spark: SparkSession, store: str, batch_id: int, value: int | None) -> None:
    spark.range(1).select(F.lit(value).cast("bigint").alias("mark")).write.mode("overwrite").parquet(f"{store}/marks/batch={batch_id}")


def forget(spark: SparkSession, store: str, first_hour: int) -> None:
    """Remove stored hours before the first one that is still needed; late rows stay."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{store}/rows/late=false")
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for place in files.listStatus(root) if files.exists(root) else []:
        name = place.getPath().getName()
        if name.startswith("hour=") and name[5:].lstrip("-").isdigit() and int(name[5:]) < first_hour:
            files.delete(place.getPath(), True)
