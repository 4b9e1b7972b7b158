"""Reports over the unified log table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.times import hour_label
from sluice.functions.values import mean, percent, rows
from sluice.operators.aggregates import shares, value_list


def by_log_type(logs: DataFrame) -> DataFrame:
    return logs.groupBy("log_type").agg(
        rows().alias("total_events"),
        F.countDistinct("ip_address").alias("unique_ips"),
        mean("response_size").alias("avg_response_size"),
        F.max("timestamp").alias("latest_timestamp"),
        F.min("timestamp").alias("earliest_timestamp"),
    )


def by_hour(logs: DataFrame) -> DataFrame:
    return logs.groupBy(hour_label("timestamp").alias("hour"), "log_type").agg(
        rows().alias("events_per_hour"),
        F.countDistinct("ip_address").alias("unique_ips_per_hour"),
        mean("response_size").alias("avg_response_size_per_hour"),
    )


def by_status(logs: DataFrame) -> DataFrame:
    """Percentages are of all rows, also those without a status."""
    return shares(logs, ["status_code"], present="status_code").select(
        "status_code", F.col("count").alias("status_count"), F.col("percentage").alias("status_percentage")
    )


def top_addresses(logs: DataFrame, n: int = 100) -> DataFrame:
    counted = logs.groupBy("ip_address").agg(rows().alias("request_count"))
    return counted.orderBy(F.desc("request_count"), "ip_address").limit(n)


def application(logs: DataFrame) -> DataFrame:
    return logs.filter(F.col("log_type") == "application")


def by_level(logs: DataFrame) -> DataFrame:
    return application(logs).groupBy("level").agg(
        rows().alias("count"),
        F.countDistinct("logger").alias("unique_loggers"),
        F.countDistinct("user_id").alias("unique_users"),
    )


def problem_messages(logs: DataFrame) -> DataFrame:
    """Errors and warnings by logger and level, with every distinct message and its count.

    Messages are open-ended text, so they stay one per row.
    """
    problems = application(logs).filter(F.col("level").isin("ERROR", "WARN"))
    listed = value_list(problems, ["logger", "level"], "message").withColumnRenamed("count", "message_count")
    counted = listed.groupBy("logger", "level").agg(F.sum("message_count").alias("error_count"))
    return listed.join(counted, ["logger", "level"])


def active_users(logs: DataFrame, n: int = 50) -> DataFrame:
    return (
        application(logs)
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            rows().alias("activity_count"),
            F.countDistinct("logger").alias("modules_used"),
            F.max("timestamp").alias("last_activity"),
        )
        .orderBy(F.desc("activity_count"), "user_id")
        .limit(n)
    )


def summary_of_reports(logs: DataFrame) -> DataFrame:
    """Figures over the groups of the reports above, from two aggregations: by hour and status, and by address."""
    per_status = logs.groupBy("log_type", F.date_trunc("hour", "timestamp").alias("hour"), "status_code").agg(rows().alias("_n"))

    def added(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("_n")))

    rate = percent(added(F.col("status_code") >= 400), added(F.col("status_code").isNotNull()))
    per_hour = per_status.groupBy("log_type", "hour").agg(F.sum("_n").alias("_n"))
    hourly = per_hour.groupBy("log_type").agg(
        F.try_divide(F.sum("_n"), rows()).alias("mean_per_hour"), F.max("_n").alias("max_per_hour")
    )
    seen = logs.groupBy("ip_address", "log_type").agg(rows().alias("_n"))
    totals = seen.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_events"), F.count("ip_address").alias("total_unique_ips"))
    counted = seen.groupBy("ip_address").agg(F.sum("_n").alias("request_count"))
    busiest = counted.orderBy(F.desc("request_count"), "ip_address").limit(100)
    # At most a hundred addresses are left.
    first = F.row_number().over(Window.orderBy(F.desc("request_count"), "ip_address")) <= 10
    share = percent(F.sum(F.when(F.col("_first"), F.col("request_count"))), F.sum("request_count"))
    return (
        totals.select(F.inline(_items("total_events", "total_unique_ips")))
        .union(per_status.agg(rate.alias("error_rate")).select(F.inline(_items("error_rate"))))
        .union(hourly.select(F.inline(_items("mean_per_hour", "max_per_hour", label="log_type"))))
        .union(busiest.withColumn("_first", first).agg(share.alias("top_10_ip_share")).select(F.inline(_items("top_10_ip_share"))))
    )


def _items(*names: str, label: str | None = None):
    def named(name: str):
        return F.concat(F.lit(name + " "), F.col(label)) if label else F.lit(name)

    return F.array(*[F.struct(named(n).alias("item"), F.col(n).cast("double").alias("value")) for n in names])
