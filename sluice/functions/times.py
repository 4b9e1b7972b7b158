"""Column helpers for event time, partition keys and dirty timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.values import col

# Partition folder layouts by granularity.
LAYOUTS = {
    "hour": (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH")),
    "day": (("year", "yyyy"), ("month", "MM"), ("day", "dd")),
    "month": (("year", "yyyy"), ("month", "MM")),
}

# Fixed value: the time format of web server access logs.
ACCESS_LOG_TIME = "dd/MMM/yyyy:HH:mm:ss Z"


def day(ts: Column | str) -> Column:
    return F.to_date(col(ts))


def hour_label(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd HH:00:00")


def month_label(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


# Fixed value: a whole date and a time to the minute or finer, with an optional fraction and zone.
ISO_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.,][0-9]+)?)?(Z|[+-][0-9]{2}(:?[0-9]{2})?)?$"


def parse_iso(text: Column | str) -> Column:
    """ISO-8601 date and time to a timestamp; null for anything else, also a date or a time alone."""
    return F.when(col(text).rlike(ISO_TIME), F.try_to_timestamp(col(text)))


def parse_access_time(text: Column | str) -> Column:
    return F.try_to_timestamp(col(text), F.lit(ACCESS_LOG_TIME))


def seconds_between(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def time_slice(ts: Column | str, seconds: float) -> Column:
    """Number of the fixed-width slice of time a row belongs to."""
    return F.floor(micros(ts) / F.lit(max(int(seconds * 1_000_000), 1)))


def partition_columns(ts: Column | str, granularity: str = "hour") -> dict[str, Column]:
    """Zero-padded text columns for a Hive-style folder layout."""
    return {name: F.date_format(col(ts), fmt) for name, fmt in LAYOUTS[granularity]}


def partition_key(ts_text: Column | str, granularity: str = "hour") -> Column:
    """Folder key such as ``year=2024/month=01``; ``unknown`` parts when the time is missing."""
    parsed = parse_iso(ts_text)
    parts = [
        F.concat(F.lit(f"{name}="), F.coalesce(F.date_format(parsed, fmt), F.lit("unknown")))
        for name, fmt in LAYOUTS[granularity]
    ]
    return F.concat_ws("/", *parts)


def weekday_name(day_of_week: Column | str) -> Column:
    """Name for Spark's day number, in which Sunday is 1."""
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), col(day_of_week))
