"""Window analytics over series.

The functions here take *series tables*: one row per group and period, as a preceding
aggregation leaves them. Their groups grow with the calendar, not with the data, so a window
per group is safe. For windows over raw rows use :mod:`sluice.operators.ordered`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.times import day, micros
from sluice.functions.values import combined_total, growth, partial_total, percent, ratio, rows, total, total_over
from sluice.operators.ordered import HOT, SLICE_ROWS, hot_slices, ordered_scan

FIRST, LAST = Window.unboundedPreceding, Window.unboundedFollowing


def exact_sum(c: str, w) -> Column:
    return total_over(c, w)


def exact_mean(c: str, w) -> Column:
    return F.try_divide(exact_sum(c, w), F.count(c).over(w))


def group_ranks(series: DataFrame, keys: list[str], by: str, ties: list[str]) -> DataFrame:
    """Position and rank within each group, largest value first."""
    turn = Window.partitionBy(*keys).orderBy(F.desc(by), *ties)
    level = Window.partitionBy(*keys).orderBy(F.desc(by))
    return series.withColumns({"group_position": F.row_number().over(turn), "group_rank": F.rank().over(level)})


def neighbours(series: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Previous and next value, and growth in percent against the previous and the first one.

    ``last_so_far`` follows the default frame, which ends at the current row; ``last_of_all``
    looks at the whole group.
    """
    w = Window.partitionBy(*keys).orderBy(at)
    whole = w.rowsBetween(FIRST, LAST)
    out = series.withColumns(
        {
            "previous": F.lag(value).over(w),
            "next": F.lead(value).over(w),
            "first": F.first(value).over(whole),
            "last_so_far": F.last(value).over(w.rowsBetween(FIRST, 0)),
            "last_of_all": F.last(value).over(whole),
        }
    )
    return out.withColumns(
        {"growth_percent": growth(value, "previous"), "growth_since_first": growth(value, "first")}
    )


def running(series: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Running total and mean, rows with the same period included."""
    w = Window.partitionBy(*keys).orderBy(at).rangeBetween(FIRST, Window.currentRow)
    return series.withColumns({"running_total": exact_sum(value, w), "running_mean": exact_mean(value, w)})


def moving_mean(series: DataFrame, keys: list[str], at: str, value: str, n: int, name: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(1 - n, 0)
    return series.withColumn(name, exact_mean(value, w))


def contribution(series: DataFrame, group: str, value: str) -> DataFrame:
    """Group total and mean on every row, with the row's ratio to the mean and share of the total."""
    whole = Window.partitionBy(group)
    out = series.withColumns({"group_total": total_over(value, whole), "group_mean": exact_mean(value, whole)})
    return out.withColumns(
        {"to_group_mean": ratio(value, "group_mean"), "share_percent": percent(value, "group_total")}
    )


def changes(series: DataFrame, keys: list[str], at: str, value: str) -> DataFrame:
    """Difference to the previous value, absolute and in percent."""
    previous = F.lag(value).over(Window.partitionBy(*keys).orderBy(at))
    out = series.withColumn("previous", previous)
    return out.withColumns(
        {"change": F.col(value) - F.col("previous"), "change_percent": growth(value, "previous")}
    )


def volatility(series: DataFrame, keys: list[str], at: str, value: str, n: int = 5) -> DataFrame:
    """Mean, minimum, maximum and deviation of the last n rows, and the value against that mean."""
    w = Window.partitionBy(*keys).orderBy(at).rowsBetween(1 - n, 0)
    out = series.withColumns(
        {
            "moving_mean": F.avg(value).over(w),
            "moving_min": F.min(value).over(w),
            "moving_max": F.max(value).over(w),
            "moving_stddev": F.stddev_samp(value).over(w),
        }
    )
    return out.withColumn("to_mean", ratio(value, "moving_mean"))


def days_back(keys: list[str], date: str, days: int) -> str:
    """Frame over a number of calendar days, for use in a SQL expression."""
    by = f"PARTITION BY {', '.join(keys)} " if keys else ""
    return f"({by}ORDER BY {date} RANGE BETWEEN INTERVAL {days} DAYS PRECEDING AND CURRENT ROW)"


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows per group. Spark applies the limit inside each task before the shuffle."""
    turn = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(turn)).filter(F.col("position") <= n)


def daily_trends(events: DataFrame, group: str, ts: str, amount: str, n: int = 7) -> DataFrame:
    """Daily events, revenue and active users per group, with their moving means over n rows."""
    daily = events.groupBy(day(ts).alias("date"), group).agg(
        rows().alias("daily_events"),
        *partial_total(amount),
        total(amount).alias("daily_revenue"),
        F.countDistinct("user_id").alias("daily_active_users"),
    )
    w = Window.partitionBy(group).orderBy("date").rowsBetween(1 - n, 0)
    return daily.select(
        "date",
        group,
        "daily_events",
        "daily_revenue",
        "daily_active_users",
        F.avg("daily_events").over(w).alias("events_ma"),
        ratio(combined_total(w), F.count_if(F.col("_values") > 0).over(w)).alias("revenue_ma"),
        F.avg("daily_active_users").over(w).alias("users_ma"),
    )


def hourly_trend(events: DataFrame, ts: str, amount: str, n: int = 3) -> DataFrame:
    """Hourly totals with moving means. The unpartitioned window runs over one row per hour."""
    hourly = events.groupBy(F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")).agg(
        rows().alias("events"),
        *partial_total(amount),
        total(amount).alias("revenue"),
        F.countDistinct("user_id").alias("active_users"),
    )
    w = Window.orderBy("hour").rowsBetween(1 - n, 0)
    return hourly.select(
        "hour",
        "events",
        "revenue",
        "active_users",
        F.avg("events").over(w).alias("events_ma"),
        ratio(combined_total(w), F.count_if(F.col("_values") > 0).over(w)).alias("revenue_ma"),
    )


def user_sequence(events: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Each event's number within its user, what came before it, and the minutes in between."""
    flagged, slices = hot_slices(events.withColumn("_us", micros("timestamp")), ["user_id"], "_us", "event_id", slice_rows=slice_rows)
    scanned = ordered_scan(
        flagged,
        ["user_id"],
        ["timestamp", "event_id"],
        slices,
        sums={"event_sequence": F.lit(1)},
        previous={"previous_event": "event_type", "previous_amount": "amount", "_previous_time": "timestamp"},
    )
    seconds = F.unix_timestamp("timestamp") - F.unix_timestamp("_previous_time")
    return scanned.withColumn("minutes_since_previous", seconds / F.lit(60)).drop("_previous_time", "_us", HOT)
