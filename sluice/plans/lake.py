"""From raw records to cleaned events to daily tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import mask_ip
from sluice.functions.times import day, parse_iso
from sluice.functions.values import mean, ratio, rows, total
from sluice.operators.project import first_per_key
from sluice.operators.quality import field, is_valid, parsed


def silver_events(records: DataFrame, received_at: str, text: str = "record") -> DataFrame:
    """Valid records only, typed and named, the first copy of each event."""
    kept = parsed(records, text).filter(is_valid())
    typed = kept.select(
        field("event_id", "bigint").alias("event_id"),
        parse_iso(field("timestamp")).cast("timestamp_ntz").alias("event_time"),
        field("event_type").alias("event_type"),
        field("user_id", "bigint").alias("user_id"),
        F.coalesce(field("session_id"), F.lit("unknown")).alias("session_id"),
        mask_ip(field("ip_address")).alias("ip_address"),
        F.coalesce(field("value", "double"), F.lit(0.0)).alias("amount"),
        F.col(received_at).alias("received_at"),
    )
    return first_per_key(typed, ["event_id"], ["received_at", "event_time"])


def valid_events(tagged: DataFrame) -> DataFrame:
    """Rows a batch job takes from tagged records."""
    return tagged.filter(
        (F.col("data_quality") == "valid") & F.col("timestamp").isNotNull() & F.col("event_type").isNotNull()
    )


def gold_daily(silver: DataFrame) -> DataFrame:
    return silver.groupBy(day("event_time").alias("event_date"), "event_type").agg(
        rows().alias("events"),
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("session_id").alias("sessions"),
        total("amount").alias("revenue"),
        mean("amount").alias("avg_amount"),
    )


def gold_users(silver: DataFrame) -> DataFrame:
    return silver.groupBy("user_id").agg(
        rows().alias("events"),
        F.countDistinct("session_id").alias("sessions"),
        total("amount").alias("revenue"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )


def kpi(daily: DataFrame, start: Column, end: Column, event_types: list[str] | None = None) -> DataFrame:
    """Key figures between two dates, from the daily table."""
    chosen = daily.filter(F.col("event_date").between(start, end))
    if event_types:
        chosen = chosen.filter(F.col("event_type").isin(event_types))
    return chosen.groupBy("event_type").agg(
        F.sum("events").alias("events"),
        total("revenue").alias("revenue"),
        ratio(total("revenue"), F.sum("events")).alias("revenue_per_event"),
        F.max("users").alias("peak_users"),
    )
