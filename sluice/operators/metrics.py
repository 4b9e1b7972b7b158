"""Metric tables, alarms over them, and capacity rules for partitioned streams."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.values import col, percent, rows, total


def metric_table(
    df: DataFrame, namespace: str, at: str, metrics: dict[str, tuple[str, str]], dimensions: list[str]
) -> DataFrame:
    """Metric points in long form, from an aggregated table.

    ``metrics`` maps a column to its metric name and unit. A row gives one point per metric.
    """
    points = F.array(
        *[
            F.struct(
                F.lit(name).alias("metric"), F.col(c).cast("double").alias("value"), F.lit(unit).alias("unit")
            )
            for c, (name, unit) in metrics.items()
        ]
    )
    return df.select(F.lit(namespace).alias("namespace"), F.col(at).alias("at"), *dimensions, F.inline(points))


def pattern_points(
    logs: DataFrame, namespace: str, at: str, text: str, patterns: Mapping[str, str], period: str = "60 seconds", where: Column | None = None
) -> DataFrame:
    """Metric points from log lines: per metric and period, the lines that match its pattern.

    A pattern without a group counts its lines; with one, the value is the sum of the numbers that the first group
    finds (a text that is no number counts nothing). All patterns are looked at in one pass, and only lines that match one are
    shuffled, summed per task first. ``where`` filters the lines before.
    """
    lines = logs if where is None else logs.filter(where)
    found = []
    for metric, pattern in patterns.items():
        grouped = re.compile(pattern).groups > 0
        value = F.regexp_extract(text, pattern, 1).try_cast("double") if grouped else F.lit(1.0)
        unit = F.lit("None" if grouped else "Count")
        found.append(F.when(F.col(text).rlike(pattern), F.struct(F.lit(metric).alias("metric"), value.alias("value"), unit.alias("unit"))))
    hits = lines.select(F.window(at, period).start.alias("at"), F.explode(F.filter(F.array(*found), lambda h: h["value"].isNotNull())).alias("hit"))
    sums = hits.groupBy("at", "hit.metric", "hit.unit").agg(total("hit.value").alias("value"))
    return sums.select(F.lit(namespace).alias("namespace"), "at", "metric", "value", "unit")


def metric_statistics(points: DataFrame, period: str = "300 seconds", dimensions: list[str] | None = None) -> DataFrame:
    """Sum, average, minimum, maximum and count per metric, dimension and period."""
    w = F.window("at", period)
    return (
        points.groupBy("namespace", "metric", *(dimensions or []), w.alias("window"))
        .agg(
            F.sum("value").alias("sum"),
            F.avg("value").alias("average"),
            F.min("value").alias("minimum"),
            F.max("value").alias("maximum"),
            rows().alias("samples"),
        )
        .withColumn("period_start", F.col("window.start"))
        .drop("window")
    )


# The comparisons an alarm can make.
COMPARE = {
    "GreaterThanThreshold": lambda v, t: v > t,
    "GreaterThanOrEqualToThreshold": lambda v, t: v >= t,
    "LessThanThreshold": lambda v, t: v < t,
    "LessThanOrEqualToThreshold": lambda v, t: v <= t,
}


@dataclass(frozen=True)
class AlarmRule:
    """ALARM once a statistic of a metric breaks its limit ``periods`` times in a row."""

    name: str
    metric: str
    statistic: str
    comparison: str
    threshold: float
    periods: int = 1


def alarm_table(statistics: DataFrame, rules: Sequence[AlarmRule], period_seconds: int = 300, dimensions: Sequence[str] = ()) -> DataFrame:
    """State of every alarm per period, from one pass over the statistics.

    Every combination of the dimensions has a state of its own. A period without data breaks
    a row of breaches: the frame counts periods, not rows.
    """
    watched = [
        F.when(
            F.col("metric") == r.metric,
            F.struct(F.lit(r.name).alias("alarm"), F.col(r.statistic).alias("value"), COMPARE[r.comparison](F.col(r.statistic), F.lit(r.threshold)).alias("_breach")),
        )
        for r in rules
    ]
    number = F.floor(F.unix_timestamp(F.col("period_start").cast("timestamp")) / F.lit(period_seconds))
    keys = ["namespace", "metric", *dimensions]
    series = statistics.select(*keys, "period_start", number.alias("_period"), F.inline(F.array_compact(F.array(*watched))))
    turn = Window.partitionBy(*keys, "alarm").orderBy("_period")
    state = F.lit("OK")
    for r in rules:
        broken = F.count_if("_breach").over(turn.rangeBetween(1 - r.periods, 0))
        state = F.when((F.col("alarm") == r.name) & (broken >= r.periods), "ALARM").otherwise(state)
    return series.select("alarm", *keys, "period_start", "value", state.alias("state"))


def alarms(
    statistics: DataFrame,
    metric: str,
    statistic: str,
    comparison: str,
    threshold: float,
    periods: int = 1,
    period_seconds: int = 300,
    dimensions: Sequence[str] = (),
) -> DataFrame:
    """State of one alarm per period; see :func:`alarm_table`."""
    rule = AlarmRule(metric, metric, statistic, comparison, threshold, periods)
    return alarm_table(statistics, [rule], period_seconds, dimensions).drop("alarm")


# Success rates in percent below which an alarm level is reached.
RATE_LEVELS = ((90, "CRITICAL"), (95, "WARNING"))


def rate_level(rate: Column | str) -> Column:
    label = F.lit("OK")
    for limit, name in reversed(RATE_LEVELS):
        label = F.when(col(rate) < limit, name).otherwise(label)
    return label


# Routing keys and how evenly they spread.


def key_strategies(ts: str = "timestamp", buckets: int = 10) -> dict[str, Column]:
    """Candidate routing keys for an event."""
    minute = F.floor(F.minute(ts) / F.lit(60 // buckets))
    return {
        "user": F.col("user_id").cast("string"),
        "hash": F.md5(F.col("event_id").cast("string")),
        "time": F.concat_ws("_", F.lpad(F.hour(ts).cast("string"), 2, "0"), F.lpad(minute.cast("string"), 2, "0")),
        "composite": F.concat_ws("_", F.col("user_id").cast("string"), "category"),
        "random": F.expr("uuid()"),
    }


def md5_bucket(key: Column, n: int) -> Column:
    """The MD5 of a key, as one number, modulo n. The digest is taken in four parts of 32 bits."""
    return digest_bucket(F.md5(key), n)


def digest_bucket(digest: Column, n: int) -> Column:
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        part = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(2**32 % n) + part) % n
    return rest.cast("int")


def key_balance(df: DataFrame, strategies: dict[str, Column], buckets: int = 4) -> DataFrame:
    """Rows per bucket for each strategy and the coefficient of variation in percent.

    Buckets no key falls into count as zero.
    """
    keys = F.array(
        *[F.struct(F.lit(n).alias("strategy"), F.md5(k).alias("digest")) for n, k in strategies.items()]
    )
    placed = df.select(F.inline(keys)).select("strategy", digest_bucket(F.col("digest"), buckets).alias("bucket"))
    counted = placed.groupBy("strategy", "bucket").agg(rows().alias("n"))
    wide = counted.groupBy("strategy").pivot("bucket", list(range(buckets))).agg(F.sum("n"))
    counts = F.array(*[F.coalesce(F.col(str(b)), F.lit(0)) for b in range(buckets)])
    lines = wide.select("strategy", F.posexplode(counts).alias("bucket", "records"))
    per = Window.partitionBy("strategy")
    mean, dev = F.avg("records").over(per), F.stddev_pop("records").over(per)
    return lines.select(
        "strategy", "bucket", "records",
        percent("records", F.sum("records").over(per)).alias("percentage"),
        F.coalesce(F.try_divide(dev, mean) * 100, F.lit(0.0)).alias("variation"),
    )


# What one partition takes, and the head room on top.
PARTITION_MB, PARTITION_RECORDS, HEAD_ROOM = 1.0, 1000, 1.2


def capacity(mb_per_second: Column, records_per_second: Column, partition_keys: Column) -> list[Column]:
    """Partitions needed by bytes, by records and by keys, the most of them, and with head room."""
    by_bytes = F.ceil(mb_per_second / F.lit(PARTITION_MB))
    by_records = F.ceil(records_per_second / F.lit(PARTITION_RECORDS))
    need = F.greatest(by_bytes, by_records, partition_keys)
    return [
        by_bytes.alias("throughput_based"),
        by_records.alias("records_based"),
        partition_keys.alias("partition_based"),
        need.alias("minimum_partitions"),
        F.ceil(need * F.lit(HEAD_ROOM)).alias("recommended_partitions"),
    ]


def capacity_report(events: DataFrame, ts: str, size: Column, key: str) -> DataFrame:
    """The capacity a stream needs at its busiest second."""
    per_second = events.groupBy(F.date_trunc("second", ts).alias("_at")).agg(
        F.sum(size.cast("bigint")).alias("_bytes"), rows().alias("_n")
    )
    keys = events.agg(F.countDistinct(key)).scalar()
    peak = per_second.agg(
        (F.max("_bytes") / F.lit(1048576.0)).alias("mb_per_second"), F.max("_n").alias("records_per_second")
    )
    return peak.select("*", *capacity(F.col("mb_per_second"), F.col("records_per_second"), keys))


# Load per partition in MB/s that asks for more or fewer, and the largest count.
SCALE_OUT_MB, SCALE_IN_MB, MOST_PARTITIONS = 0.8, 0.2, 100


def scale_advice(
    bytes_per_second: Column,
    partitions: Column,
    out_mb: float = SCALE_OUT_MB,
    in_mb: float = SCALE_IN_MB,
) -> list[Column]:
    """Double, halve or keep the partition count, from the average load per partition."""
    load = F.try_divide(bytes_per_second / F.lit(1048576.0), partitions)
    action = (
        F.when((partitions > 0) & (load > out_mb), "scale_out")
        .when((partitions > 1) & (load < in_mb), "scale_in")
        .otherwise("hold")
    )
    target = (
        F.when(action == "scale_out", F.least(partitions * 2, F.lit(MOST_PARTITIONS)))
        .when(action == "scale_in", F.greatest(F.floor(partitions / 2).cast("int"), F.lit(1)))
        .otherwise(partitions)
    )
    return [load.alias("mb_per_partition"), action.alias("action"), target.cast("int").alias("target_partitions")]
