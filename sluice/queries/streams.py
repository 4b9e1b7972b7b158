"""Table forms of the streaming analyses; the tests compare them with the streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import sessions as runs
from sluice.queries.registry import query
from sluice.sources import tables as t
from sluice.streaming import windows

TOTAL, MEAN = "CAST(sum(m) AS DOUBLE)", "CAST(sum(m) AS DOUBLE) / count(m)"


def bucket(minutes: int) -> str:
    start = f'time_bucket(INTERVAL {minutes} MINUTE, "timestamp")'
    return f"{start} AS window_start, {start} + INTERVAL {minutes} MINUTE AS window_end"


@query(
    "tumble_type",
    f"""SELECT {bucket(5)}, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
          {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev WHERE amount IS NOT NULL GROUP BY 1, 2, 3""",
    "ev",
)
def tumble_type(spark, folder):
    return windows.by_type(t.events(spark, folder))


@query(
    "tumble_user",
    f"""SELECT {bucket(5)}, user_id, count(*) AS event_count, count(DISTINCT session_id) AS sessions,
          {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev WHERE user_id IS NOT NULL GROUP BY 1, 2, 3""",
    "ev",
)
def tumble_user(spark, folder):
    return windows.by_user(t.events(spark, folder))


@query(
    "tumble_logs",
    f"""SELECT {bucket(1)}, log_type, count(*) AS request_count, count(DISTINCT ip_address) AS unique_ips,
          CAST(sum(response_size) AS DOUBLE) / count(response_size) AS avg_response_size FROM ev GROUP BY 1, 2, 3""",
    "ev",
)
def tumble_logs(spark, folder):
    return windows.by_log_type(t.events(spark, folder))


@query(
    "tumble_count",
    f"SELECT {bucket(1)}, count(*) AS event_count FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2",
    "ev",
)
def tumble_count(spark, folder):
    return windows.counts(t.events(spark, folder), F.col("event_type") == "purchase")


PATHS = f"""WITH placed AS (
      SELECT *, (row_number() OVER (PARTITION BY session_id, user_id, window_start ORDER BY "timestamp", event_id) - 1) // 2 AS segment
      FROM (SELECT *, time_bucket(INTERVAL 30 MINUTE, "timestamp") AS window_start FROM ev)),
    whole AS (
      SELECT session_id, user_id, window_start,
        CAST(epoch_us(max("timestamp")) - epoch_us(min("timestamp")) AS DOUBLE) / 1000000.0::DOUBLE AS duration_seconds,
        {TOTAL} AS total_value,
        string_agg(event_type, ' -> ' ORDER BY "timestamp", event_id) LIKE '%view%click%purchase%' AS converted
      FROM placed GROUP BY 1, 2, 3)
    SELECT session_id, user_id, window_start, segment, event_sequence, duration_seconds, total_value, converted
    FROM (SELECT session_id, user_id, window_start, segment, string_agg(event_type, ' -> ' ORDER BY "timestamp", event_id) AS event_sequence
          FROM placed GROUP BY 1, 2, 3, 4) JOIN whole USING (session_id, user_id, window_start)"""


@query("behavior_path", PATHS, "ev")
def behavior_path(spark, folder):
    """Segments of two events, so that paths of the test data fall into several."""
    return runs.behavior_paths(t.events(spark, folder), segment=2)


@query(
    "sessions",
    f"""WITH marked AS (SELECT *, CASE WHEN "timestamp" - lag("timestamp") OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
          FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id)),
        runs AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY "timestamp", event_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM marked)
        SELECT user_id, min("timestamp") AS session_start, max("timestamp") + INTERVAL 30 MINUTE AS session_end,
          CAST(epoch_us(max("timestamp")) + 1800000000 - epoch_us(min("timestamp")) AS DOUBLE) / 60000000.0::DOUBLE
            AS duration_minutes,
          count(*) AS event_count, {TOTAL} AS total_value,
          string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types
        FROM runs GROUP BY user_id, run""",
    "ev",
)
def sessions(spark, folder):
    out = runs.sessions(t.events(spark, folder), "user_id", "timestamp", "amount", "event_type")
    return out.withColumn("event_types", F.array_join("event_types", ","))


SCORED = """SELECT *, abs(amount - mu) / nullif(sd, 0) AS score FROM (
  SELECT *, CAST(sum(m) OVER w AS DOUBLE) / count(m) OVER w AS mu, stddev_samp(amount) OVER w AS sd FROM ev
  WINDOW w AS (PARTITION BY event_type ORDER BY "timestamp" RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW))"""


@query(
    "anomaly_1h",
    f"""SELECT event_id, event_type, amount AS current_value, mu AS moving_average,
          round(score, 6) AS anomaly_score, coalesce(score > 2, false) AS is_anomaly FROM ({SCORED})""",
    "ev",
)
def anomaly_1h(spark, folder):
    """The limit is lowered, as an hour of the test data holds too few rows for a score above 3."""
    raw = t.events(spark, folder).select("event_id", "event_type", "timestamp", "amount")
    return windows.hourly_deviation(raw, limit=2.0).select(
        "event_id", "event_type", F.col("amount").alias("current_value"),
        F.col("moving_mean").alias("moving_average"),
        F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly",
    )


@query(
    "alerts",
    f"""SELECT "timestamp", 'ANOMALY_DETECTED' AS alert_type, event_type, round(score, 6) AS anomaly_score,
          amount AS current_value, mu AS expected_range FROM ({SCORED}) WHERE score > 2""",
    "ev",
)
def alerts(spark, folder):
    raw = t.events(spark, folder).select("event_type", "timestamp", "amount")
    found = windows.alerts(windows.hourly_deviation(raw, limit=2.0))
    return found.withColumn("anomaly_score", F.round("anomaly_score", 6))


@query(
    "fraud_alerts",
    """SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS window_start, user_id,
         'High frequency transactions' AS suspicious_activity, CAST(count(*) AS DOUBLE) AS risk_score,
         CASE WHEN count(*) > 2 THEN 'HIGH' WHEN count(*) > 1 THEN 'MEDIUM' ELSE 'LOW' END AS alert_level
       FROM ev WHERE event_type = 'purchase' GROUP BY 1, 2 HAVING count(*) > 0""",
    "ev",
)
def fraud_alerts(spark, folder):
    """The limits are lowered to what the test data reaches."""
    return windows.frequent_purchases(t.events(spark, folder), more_than=0, medium=1, high=2)
