"""Event-time windows. Every function takes a stream or a table and gives the same columns.

Streams need a TIMESTAMP column with a watermark. They cannot count distinct values
directly, so a stream aggregates twice: first per window, key and value, then per window and key.
A row of state holds one value, however many a window has, and a busy window spreads over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.values import combined_mean, combined_total, mean, partial_total, rows, total
from sluice.operators.ordered import moving_statistics


def watermarked(stream: DataFrame, ts: str, delay: str = "5 seconds") -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def tumbling(df: DataFrame, ts: str, length: str, keys: list[str], measures: list[Column]) -> DataFrame:
    return named_window(df.groupBy(F.window(ts, length).alias("window"), *keys).agg(*measures))


def named_window(df: DataFrame) -> DataFrame:
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "*").drop("window")


def metrics(
    df: DataFrame, ts: str, length: str, keys: list[str], count: str, different: tuple[str, str], value: str, total_name: str | None, mean_name: str
) -> DataFrame:
    """Rows, different values of a column, total and mean of an amount per window and key.

    ``different`` is the column and the name of its count; nulls do not count as a value. A null ``total_name`` leaves the total out.
    """
    column, name = different
    if not df.isStreaming:
        out = [rows().alias(count), F.countDistinct(column).alias(name), total(value).alias("_total"), mean(value).alias(mean_name)]
        return ordered_columns(tumbling(df, ts, length, keys, out), keys, count, name, total_name, mean_name)
    first = df.groupBy(F.window(ts, length).alias("window"), *keys, column).agg(rows().alias("_rows"), *partial_total(value))
    second = first.groupBy("window", *keys).agg(
        F.sum("_rows").alias(count), F.count(column).alias(name), combined_total().alias("_total"), combined_mean().alias(mean_name)
    )
    return ordered_columns(named_window(second), keys, count, name, total_name, mean_name)


def ordered_columns(df: DataFrame, keys: list[str], count: str, name: str, total_name: str | None, mean_name: str) -> DataFrame:
    shown = [F.col("_total").alias(total_name)] if total_name else []
    return df.select("window_start", "window_end", *keys, count, name, *shown, mean_name)


def by_type(events: DataFrame, ts: str = "timestamp", value: str = "amount") -> DataFrame:
    """Five-minute metrics per event type."""
    known = events.filter(F.col(value).isNotNull())
    return metrics(known, ts, "5 minutes", ["event_type"], "event_count", ("user_id", "unique_users"), value, "total_value", "avg_value")


def by_user(events: DataFrame, ts: str = "timestamp", value: str = "amount") -> DataFrame:
    """Five-minute metrics per user."""
    known = events.filter(F.col("user_id").isNotNull())
    return metrics(known, ts, "5 minutes", ["user_id"], "event_count", ("session_id", "sessions"), value, "total_value", "avg_value")


def by_log_type(logs: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One-minute request metrics per log type."""
    return metrics(logs, ts, "1 minute", ["log_type"], "request_count", ("ip_address", "unique_ips"), "response_size", None, "avg_response_size")


def counts(df: DataFrame, condition: Column, ts: str = "timestamp", length: str = "1 minute") -> DataFrame:
    """Rows per window that meet a condition."""
    return tumbling(df.filter(condition), ts, length, [], [rows().alias("event_count")])


def frequent_purchases(
    events: DataFrame, ts: str = "timestamp", more_than: int = 10, medium: int = 20, high: int = 50
) -> DataFrame:
    """Users with too many purchases within five minutes, and how alarming that is."""
    counted = tumbling(
        events.filter(F.col("event_type") == "purchase"), ts, "5 minutes", ["user_id"], [rows().alias("_n")]
    )
    level = F.when(F.col("_n") > high, "HIGH").when(F.col("_n") > medium, "MEDIUM").otherwise("LOW")
    return counted.filter(F.col("_n") > more_than).select(
        "window_start", "user_id",
        F.lit("High frequency transactions").alias("suspicious_activity"),
        F.col("_n").cast("double").alias("risk_score"),
        level.alias("alert_level"),
    )


def hourly_deviation(events: DataFrame, ts: str = "timestamp", value: str = "amount", limit: float = 3.0) -> DataFrame:
    """Each value against the mean of its event type over the preceding hour. For tables only."""
    scored = moving_statistics(events.filter(F.col(value).isNotNull()), ["event_type"], ts, value, 3600)
    score = F.try_divide(F.abs(F.col(value) - F.col("moving_mean")), F.nullif("moving_stddev", F.lit(0.0)))
    return scored.withColumn("anomaly_score", score).withColumn(
        "is_anomaly", F.coalesce(F.col("anomaly_score") > limit, F.lit(False))
    )


def alerts(scored: DataFrame, ts: str = "timestamp", value: str = "amount") -> DataFrame:
    """Alert records for the anomalies."""
    return scored.filter("is_anomaly").select(
        F.col(ts).alias("timestamp"),
        F.lit("ANOMALY_DETECTED").alias("alert_type"),
        "event_type",
        "anomaly_score",
        F.col(value).alias("current_value"),
        F.col("moving_mean").alias("expected_range"),
    )


def sessions(events: DataFrame, ts: str = "timestamp", value: str = "amount", gap: str = "30 minutes") -> DataFrame:
    """Sessions per user by inactivity. For tables with hot users see ``operators.sessions``."""
    return (
        events.groupBy("user_id", F.session_window(ts, gap).alias("_s"))
        .agg(
            rows().alias("event_count"),
            total(value).alias("total_value"),
            F.sort_array(F.collect_set("event_type")).alias("event_types"),
        )
        .select(
            "user_id",
            F.col("_s.start").alias("session_start"),
            F.col("_s.end").alias("session_end"),
            ((F.unix_micros("_s.end") - F.unix_micros("_s.start")) / F.lit(60_000_000)).alias("duration_minutes"),
            "event_count",
            "total_value",
            "event_types",
        )
    )
