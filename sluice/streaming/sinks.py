"""Where streams go: time folders, per-batch jobs, good and bad records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from sluice.functions.times import LAYOUTS, partition_columns
from sluice.operators.metrics import alarms, metric_statistics, metric_table
from sluice.operators.quality import good_and_bad, is_valid, parsed
from sluice.plans.analytics import day_metrics, day_parts
from sluice.sources.readers import MICROS

Batch = Callable[[DataFrame, int], None]


def timed(writer, every: str | None):
    """Process what is there and stop, or keep going at an interval."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def deliver(
    stream: DataFrame, path: str, checkpoint: str, ts: str, granularity: str = "hour", fmt: str = "json",
    every: str | None = None,
) -> StreamingQuery:
    """Append a stream to time folders. The file sink's log makes each batch appear once."""
    names = [name for name, _ in LAYOUTS[granularity]]
    placed = stream.withColumns(partition_columns(ts, granularity))
    writer = (
        placed.writeStream.format(fmt).options(**MICROS).option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy(*names)
    )
    return timed(writer, every).start()


def append_rows(stream: DataFrame, path: str, checkpoint: str, fmt: str = "json", every: str | None = None) -> StreamingQuery:
    """Append the finished rows of a windowed stream."""
    writer = (
        stream.writeStream.format(fmt).options(**MICROS).outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    return timed(writer, every).start()


def each_batch(
    stream: DataFrame, work: Batch, checkpoint: str, every: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Run a job per micro-batch. A batch may come again after a failure, so the job must
    replace its output by batch id or by partition."""
    writer = stream.writeStream.foreachBatch(work).outputMode(mode).option("checkpointLocation", checkpoint)
    return timed(writer, every).start()


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """Write one batch to a folder of its own, replacing an earlier attempt."""
    options = MICROS if fmt in ("json", "csv") else {}
    df.write.mode("overwrite").options(**options).format(fmt).save(f"{path}/batch={batch_id}")


def split_records(
    stream: DataFrame, received_at: str, good_path: str, bad_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Good records to one place, dead letters to another."""

    def work(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            good, bad = good_and_bad(held, F.col(received_at))
            write_batch(good.drop("json"), good_path, batch_id)
            write_batch(bad, bad_path, batch_id, "json")
        finally:
            held.unpersist()

    return each_batch(stream, work, checkpoint, every)


def quality_stream(records: DataFrame, at: str, delay: str = "10 minutes") -> DataFrame:
    """Quality metrics per five minutes of a stream of raw records."""
    checked = parsed(records).select(F.col(at).cast("timestamp").alias(at), is_valid().alias("_valid"))
    return (
        checked.withWatermark(at, delay)
        .groupBy(F.window(at, "5 minutes").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if("_valid").alias("valid_records"),
            F.count_if(~F.col("_valid")).alias("invalid_records"),
        )
        .select(F.col("w.start").alias("window_start"), "total_records", "valid_records", "invalid_records")
    )


def rerun_touched_hours(
    stream: DataFrame, ts: str, lake: str, schema: str, report: Callable[[DataFrame], DataFrame], out: str,
    checkpoint: str, every: str | None = None,
) -> StreamingQuery:
    """When new rows arrive, add them to the lake and recompute the report of just their hours.

    ``report`` maps rows to a table per ``day`` and ``hour``; its folders are replaced.
    """
    folders = ["day", "hour"]
    placed = {"day": F.date_format(ts, "yyyy-MM-dd"), "hour": F.date_format(ts, "HH")}

    def work(batch: DataFrame, batch_id: int) -> None:
        spark: SparkSession = batch.sparkSession
        held = batch.withColumns(placed).withColumn("batch", F.lit(str(batch_id))).persist()
        try:
            held.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *folders, "batch"
            ).parquet(lake)
            # One entry per hour of the batch; as literals they prune the folders to read.
            hours = [r["at"] for r in held.select(F.concat_ws(" ", *folders).alias("at")).distinct().collect()]
            stored = spark.read.schema(f"{schema}, day STRING, hour STRING, batch STRING").parquet(lake)
            touched = stored.filter(F.concat_ws(" ", *folders).isin(hours))
            report(touched).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                *folders
            ).parquet(out)
        finally:
            held.unpersist()

    return each_batch(stream, work, checkpoint, every)


def live_day(stream: DataFrame, ts: str, store: str, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep the live metrics of the latest day at ``out``, made anew with every batch.

    The state is a row per user, category and event type of a day, dropped when the watermark has passed the day. Each
    batch stores the rows it changed; the metrics are made of the last version of each row of the latest day.
    """
    parts = day_parts(stream, F.window(ts, "1 day").alias("window"))

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        placed = batch.withColumns({"day": F.date_format("window.start", "yyyy-MM-dd"), "batch": F.lit(batch_id)}).drop("window")
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(store)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in placed.schema.fields)
        stored = spark.read.schema(columns).parquet(store).filter(F.col("batch") <= batch_id)
        latest = stored.agg(F.max("day")).first()[0]
        if latest is None:
            return
        keys = ["user_id", "category", "event_type"]
        measures = [c for c in placed.columns if c[0] == "_"]
        newest = F.max_by(F.struct(*measures), "batch").alias("_newest")
        current = stored.filter(F.col("day") == latest).groupBy(*keys).agg(newest).select(*keys, "_newest.*")
        day_metrics(current).withColumn("day", F.lit(latest)).coalesce(1).write.mode("overwrite").parquet(out)

    return each_batch(parts, work, checkpoint, every, "update")


def without_duplicates(stream: DataFrame, key: str) -> DataFrame:
    """Drop repeated keys that arrive within the watermark of the first one."""
    return stream.dropDuplicatesWithinWatermark([key])


def progress_table(query: StreamingQuery) -> DataFrame:
    """One row per micro-batch: rows, speed, and how far processing is behind, as metric input."""
    spark, out = SparkSession.active(), []
    for p in query.recentProgress:
        watermark = (p["eventTime"] or {}).get("watermark")
        took = float(p["durationMs"].get("triggerExecution", 0))
        out.append((p["timestamp"], p["batchId"], p["numInputRows"], took, watermark))
    columns = "at STRING, batch BIGINT, input_rows BIGINT, trigger_ms DOUBLE, watermark STRING"
    times = {"at": F.to_timestamp("at"), "watermark": F.to_timestamp("watermark")}
    lag = F.unix_millis("at") - F.unix_millis("watermark")
    return spark.createDataFrame(out, columns).withColumns(times).withColumn("lag_ms", lag)


# How far behind a consumer may fall, and for how many periods in a row.
LAG_LIMIT_MS, LAG_PERIODS = 60_000, 2


def lag_alarms(progress: DataFrame, period_seconds: int = 60) -> DataFrame:
    """Alarm states of a consumer whose lag stays above the limit."""
    points = metric_table(
        progress.filter(F.col("lag_ms").isNotNull()), "Streaming", "at", {"lag_ms": ("ConsumerLag", "Milliseconds")}, []
    )
    series = metric_statistics(points, f"{period_seconds} seconds")
    return alarms(series, "ConsumerLag", "maximum", "GreaterThanThreshold", LAG_LIMIT_MS, LAG_PERIODS, period_seconds)
