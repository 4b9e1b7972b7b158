"""Log parsing and reports, record quality, change data, metrics and alarms."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import text
from sluice.functions.values import rows
from sluice.operators import logs, metrics, quality
from sluice.plans import lake, log_reports
from sluice.queries.registry import query
from sluice.sources import tables as t

SIZE_MEAN = "CAST(sum(response_size) AS DOUBLE) / count(response_size)"


@query(
    "log_stats",
    f"""SELECT log_type, count(*) AS total_events, count(DISTINCT ip_address) AS unique_ips,
          {SIZE_MEAN} AS avg_response_size, max("timestamp") AS latest_timestamp,
          min("timestamp") AS earliest_timestamp FROM ev GROUP BY 1""",
    "ev",
)
def log_stats(spark, folder):
    return log_reports.by_log_type(t.events(spark, folder))


@query(
    "log_hourly",
    f"""SELECT strftime("timestamp", '%Y-%m-%d %H:00:00') AS hour, log_type, count(*) AS events_per_hour,
          count(DISTINCT ip_address) AS unique_ips_per_hour, {SIZE_MEAN} AS avg_response_size_per_hour
        FROM ev GROUP BY 1, 2""",
    "ev",
)
def log_hourly(spark, folder):
    return log_reports.by_hour(t.events(spark, folder))


@query(
    "log_status",
    """SELECT status_code, count(*) AS status_count,
         count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ev) AS status_percentage
       FROM ev WHERE status_code IS NOT NULL GROUP BY 1""",
    "ev",
)
def log_status(spark, folder):
    return log_reports.by_status(t.events(spark, folder))


@query(
    "log_levels",
    """SELECT level, count(*) AS count, count(DISTINCT logger) AS unique_loggers,
         count(DISTINCT user_id) AS unique_users FROM ev WHERE log_type = 'application' GROUP BY 1""",
    "ev",
)
def log_levels(spark, folder):
    return log_reports.by_level(t.events(spark, folder))


@query(
    "log_errors",
    """SELECT logger, level, message, count(*) AS message_count,
         CAST(sum(count(*)) OVER (PARTITION BY logger, level) AS BIGINT) AS error_count
       FROM ev WHERE log_type = 'application' AND level IN ('ERROR', 'WARN') GROUP BY 1, 2, 3""",
    "ev",
)
def log_errors(spark, folder):
    return log_reports.problem_messages(t.events(spark, folder))


@query(
    "top_active",
    """SELECT user_id, count(*) AS activity_count, count(DISTINCT logger) AS modules_used,
         max("timestamp") AS last_activity FROM ev WHERE log_type = 'application' AND user_id IS NOT NULL
       GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""",
    "ev",
)
def top_active(spark, folder):
    return log_reports.active_users(t.events(spark, folder))


WEB = "event_id, \"timestamp\", ip_address, method, path, protocol, status_code, response_size, referer, user_agent, log_type"


def lines_of(spark, folder, log_type):
    return t.raw_web_lines(spark, folder).filter(F.col("log_type") == log_type).select("event_id", "line")


def plain_time(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("parse_apache", f"SELECT {WEB} FROM web WHERE log_type = 'apache_access'", "web")
def parse_apache(spark, folder):
    return plain_time(logs.parse_apache(lines_of(spark, folder, "apache_access")))


@query("parse_nginx", f"SELECT {WEB} FROM web WHERE log_type = 'nginx_access' AND NOT no_size", "web")
def parse_nginx(spark, folder):
    return plain_time(logs.parse_nginx(lines_of(spark, folder, "nginx_access")))


@query(
    "parse_app",
    """SELECT event_id, "timestamp", level, message, logger, user_id, log_type, CAST(NULL AS VARCHAR) AS thread,
         CAST(NULL AS VARCHAR) AS exception, CAST(NULL AS VARCHAR) AS request_id FROM app""",
    "app",
)
def parse_app(spark, folder):
    out = logs.parse_application(t.raw_app_lines(spark, folder))
    return plain_time(out)


@query(
    "unified_logs",
    """SELECT event_id, log_type, "timestamp", ip_address, status_code, response_size, NULL AS level, NULL AS message
         FROM web WHERE log_type = 'apache_access' OR NOT no_size
       UNION ALL SELECT event_id, log_type, "timestamp", NULL, NULL, NULL, level, message FROM app""",
    "web app",
)
def unified_logs(spark, folder):
    both = logs.unify(
        logs.parse_apache(lines_of(spark, folder, "apache_access")),
        logs.parse_nginx(lines_of(spark, folder, "nginx_access")),
        logs.parse_application(t.raw_app_lines(spark, folder)),
    )
    return plain_time(both).select(
        "event_id", "log_type", "timestamp", "ip_address", "status_code", "response_size", "level", "message"
    )


@query(
    "parse_rate",
    """SELECT log_type, count(*) AS lines, count(*) FILTER (WHERE log_type = 'apache_access' OR NOT no_size) AS parsed,
         count(*) FILTER (WHERE log_type = 'apache_access' OR NOT no_size) * 100.0::DOUBLE / count(*) AS success_rate
       FROM web GROUP BY 1""",
    "web",
)
def parse_rate(spark, folder):
    return logs.parse_rate(t.raw_web_lines(spark, folder))


@query(
    "routing_key",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN session_id WHEN 1 THEN 'orders_' || event_id
         WHEN 2 THEN 'device' || user_id ELSE CASE WHEN log_type = 'application' THEN 'default' ELSE ip_address END
       END AS routing_key FROM ev""",
    "ev",
)
def routing_key(spark, folder):
    turn = F.col("event_id") % 4
    source = F.when(turn == 0, "web").when(turn == 1, "database").when(turn == 2, "sensor").otherwise("application")
    raw = t.events(spark, folder).withColumns(
        {
            "source": source,
            "table": F.lit("orders"),
            "transaction_id": F.col("event_id").cast("string"),
            "device_id": F.concat(F.lit("device"), F.col("user_id").cast("string")),
            "request_id": F.lit(None).cast("string"),
            "ip_address": F.when((F.col("log_type") != "application") | (turn != 3), F.col("ip_address")),
        }
    )
    return raw.select("event_id", logs.routing_key("source").alias("routing_key"))


# Standardizing and validating records.


@query(
    "etl_standardize",
    """SELECT "timestamp", coalesce(event_type, 'unknown') AS event_type, user_id,
         '10.' || (user_id % 4) || '.' || (k % 16) || '.xxx' AS ip_address, status_code,
         coalesce(response_size, 0) AS response_size, TIMESTAMP '2024-02-01' AS processed_at, '1.0' AS etl_version,
         CASE WHEN status_code BETWEEN 200 AND 299 THEN 'Success' WHEN status_code BETWEEN 400 AND 499 THEN 'Client Error'
           WHEN status_code BETWEEN 500 AND 599 THEN 'Server Error' WHEN status_code IS NOT NULL THEN 'Other' END
           AS status_category FROM ev""",
    "ev",
)
def etl_standardize(spark, folder):
    return quality.standardize(t.events(spark, folder), F.lit("2024-02-01").cast("timestamp_ntz"))


@query(
    "etl_status_class",
    """SELECT CASE WHEN status_code BETWEEN 200 AND 299 THEN 'Success' WHEN status_code BETWEEN 400 AND 499 THEN 'Client Error'
         WHEN status_code BETWEEN 500 AND 599 THEN 'Server Error' WHEN status_code IS NOT NULL THEN 'Other' END
         AS status_category, count(*) AS count FROM ev GROUP BY 1""",
    "ev",
)
def etl_status_class(spark, folder):
    label = quality.status_class("status_code").alias("status_category")
    return t.events(spark, folder).groupBy(label).agg(rows().alias("count"))


@query(
    "etl_tag",
    "SELECT event_id, CASE WHEN turn IN (16, 18) THEN 'incomplete' ELSE 'valid' END AS data_quality FROM rec",
    "rec",
)
def etl_tag(spark, folder):
    checked = quality.parsed(t.raw_records(spark, folder))
    return checked.select("event_id", quality.completeness_tag().alias("data_quality"))


@query(
    "dq_batch_filter",
    "SELECT event_id, event_type FROM rec WHERE ts_text IS NOT NULL AND event_type IS NOT NULL",
    "rec",
)
def dq_batch_filter(spark, folder):
    """What a batch job takes: tagged as complete, with a time and a type."""
    checked = quality.parsed(t.raw_records(spark, folder))
    tagged = checked.select(
        "event_id", quality.completeness_tag().alias("data_quality"),
        quality.field("timestamp").alias("timestamp"), quality.field("event_type").alias("event_type"),
    )
    return lake.valid_events(tagged).select("event_id", "event_type")


@query("dq_valid", "SELECT event_id, good AS is_valid FROM rec", "rec")
def dq_valid(spark, folder):
    return quality.parsed(t.raw_records(spark, folder)).select("event_id", quality.is_valid().alias("is_valid"))


METRICS = """count(*) AS total_records, count(*) FILTER (WHERE good) AS valid_records,
  count(*) FILTER (WHERE NOT good) AS invalid_records,
  count(*) FILTER (WHERE good) * 100.0::DOUBLE / count(*) AS quality_rate"""


@query(
    "dq_metrics",
    f"""SELECT time_bucket(INTERVAL 5 MINUTE, received_at) AS window_start, {METRICS} FROM rec GROUP BY 1""",
    "rec",
)
def dq_metrics(spark, folder):
    return quality.quality_metrics(t.raw_records(spark, folder), "received_at")


SCORE = """100 - CASE turn WHEN 16 THEN 13 WHEN 17 THEN 10 WHEN 18 THEN 13 WHEN 19 THEN 10 ELSE 0 END
  - CASE WHEN user_text = '0' THEN 13 ELSE 0 END"""


@query("dq_score", f"SELECT event_id, CAST({SCORE} AS INTEGER) AS score FROM rec", "rec")
def dq_score(spark, folder):
    checked = quality.parsed(t.raw_records(spark, folder))
    return checked.select("event_id", quality.score(quality.default_rules()).alias("score"))


@query(
    "dq_report",
    f"""WITH twice AS (SELECT * FROM rec UNION ALL SELECT * FROM rec WHERE event_type = 'signup')
        SELECT count(*) AS total_records,
          count(*) FILTER (WHERE turn NOT IN (16, 18)) * 100.0::DOUBLE / count(*) AS schema_compliance,
          (count(*) * 4 - count(*) FILTER (WHERE turn = 19)) * 100.0::DOUBLE / (count(*) * 4) AS type_accuracy,
          (count(*) - count(DISTINCT event_id)) * 100.0::DOUBLE / count(*) AS duplicate_rate,
          CAST(sum({SCORE}) AS DOUBLE) / count(*) AS quality_score FROM twice""",
    "rec",
)
def dq_report(spark, folder):
    once = t.raw_records(spark, folder)
    again = once.filter(F.get_json_object("record", "$.event_type") == "signup")
    return quality.quality_report(once.unionByName(again), "event_id")


ERROR = """CASE turn WHEN 16 THEN 'missing:timestamp' WHEN 17 THEN 'rule:timestamp_format'
  WHEN 18 THEN 'missing:event_type' WHEN 19 THEN 'type:user_id' ELSE '' END"""


@query("dq_errors", f"SELECT event_id, {ERROR} AS errors FROM rec", "rec")
def dq_errors(spark, folder):
    checked = quality.parsed(t.raw_records(spark, folder))
    return checked.select("event_id", F.array_join(quality.record_errors(), "; ").alias("errors"))


@query(
    "dq_deadletter",
    f"""SELECT event_id, received_at, {ERROR} AS error, TIMESTAMP '2024-02-01' AS "timestamp", 0 AS retry_count,
          user_text AS original_user, user_text IS NULL AS no_user, session_id AS original_session FROM rec WHERE NOT good""",
    "rec",
)
def dq_deadletter(spark, folder):
    _, bad = quality.good_and_bad(t.raw_records(spark, folder), F.lit("2024-02-01").cast("timestamp_ntz"))
    user = F.get_json_object("original_record", "$.user_id")
    return bad.select(
        "event_id", "received_at", "error", "timestamp", "retry_count", user.alias("original_user"), user.isNull().alias("no_user"),
        F.get_json_object("original_record", "$.session_id").alias("original_session"),
    )


@query(
    "schema_migrate",
    """SELECT event_id, 'v1.2' AS version, CASE event_id % 3 WHEN 0 THEN 'unknown' ELSE session_id END AS session_id,
         amount AS value, CASE event_id % 3 WHEN 2 THEN '{"k":"' || k || '"}' ELSE '{}' END AS properties FROM ev""",
    "ev",
)
def schema_migrate(spark, folder):
    out = quality.migrate(t.versioned_records(spark, folder))
    return out.select("event_id", "version", "session_id", "value", "properties")


SILVER = """SELECT event_id, ts AS event_time, event_type, user_id, session_id,
  regexp_replace(ip_address, '[0-9]+$', 'xxx') AS ip_address, value AS amount, received_at FROM rec WHERE good"""


@query("silver_events", SILVER, "rec")
def silver_events(spark, folder):
    once = t.raw_records(spark, folder)
    late_copies = once.withColumn("received_at", F.col("received_at") + F.expr("INTERVAL 1 HOUR"))
    return lake.silver_events(once.unionByName(late_copies), "received_at")


GOLD = f"""SELECT CAST(event_time AS DATE) AS event_date, event_type, count(*) AS events,
  count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS avg_amount FROM ({SILVER}) GROUP BY 1, 2"""


@query("gold_daily", GOLD, "rec")
def gold_daily(spark, folder):
    return lake.gold_daily(lake.silver_events(t.raw_records(spark, folder), "received_at"))


@query(
    "gold_users",
    f"""SELECT user_id, count(*) AS events, count(DISTINCT session_id) AS sessions,
          CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS revenue, min(event_time) AS first_seen,
          max(event_time) AS last_seen FROM ({SILVER}) GROUP BY 1""",
    "rec",
)
def gold_users(spark, folder):
    return lake.gold_users(lake.silver_events(t.raw_records(spark, folder), "received_at"))


@query(
    "gold_kpi",
    f"""SELECT event_type, CAST(sum(events) AS BIGINT) AS events,
          CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
          CAST(sum(CAST(revenue AS DECIMAL(18,2))) AS DOUBLE) / CAST(sum(events) AS DOUBLE) AS revenue_per_event,
          max(users) AS peak_users FROM ({GOLD})
        WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY 1""",
    "rec",
)
def gold_kpi(spark, folder):
    daily = lake.gold_daily(lake.silver_events(t.raw_records(spark, folder), "received_at"))
    return lake.kpi(daily, F.lit("2024-01-08").cast("date"), F.lit("2024-01-21").cast("date"))


@query(
    "pii_mask",
    r"""WITH mails AS (SELECT doc_id, regexp_replace(text, '[\w.%+-]+@[a-zA-Z\d.-]+[.][a-zA-Z][a-zA-Z]+', '[EMAIL]', 'g') AS x FROM documents),
        addresses AS (SELECT doc_id, regexp_replace(x, '\b(?:\d\d?\d?[.]){3}\d\d?\d?\b', '[IP]', 'g') AS x FROM mails)
        SELECT doc_id, regexp_replace(x, '(?:[+]\d\d?\d?[-. ]?)?(?:[(]\d{2}\d?\d?[)] ?|\b\d{2}\d?\d?[-. ])\d{3}\d?[-. ]\d{4}\b', '[PHONE]', 'g') AS text
        FROM addresses""",
)
def pii_mask(spark, folder):
    return t.table(spark, folder, "documents").select("doc_id", text.mask_personal_data("text").alias("text"))


@query(
    "cdc_classify",
    """SELECT transaction_id, operation, CASE operation WHEN 'INSERT' THEN 'new_record' WHEN 'DELETE' THEN 'record_deleted'
         ELSE CASE WHEN before_status <> after_status THEN 'important_update' ELSE 'ordinary_update' END END AS change_type
       FROM cdc""",
    "cdc",
)
def cdc_classify(spark, folder):
    out = quality.classify_changes(t.change_events(spark, folder), ["status"])
    return out.select("transaction_id", "operation", "change_type")


@query(
    "cdc_apply",
    """SELECT key, after_status AS status, after_amount AS amount, "timestamp" AS changed_at FROM (
         SELECT *, row_number() OVER (PARTITION BY key ORDER BY "timestamp" DESC, transaction_id DESC) AS rn FROM cdc)
       WHERE rn = 1 AND operation <> 'DELETE'""",
    "cdc",
)
def cdc_apply(spark, folder):
    return quality.apply_changes(t.change_events(spark, folder), ["database", "table", "key"]).drop("database", "table")


@query(
    "source_stats",
    """SELECT log_type AS source, count(*) FILTER (WHERE good) AS sent, count(*) FILTER (WHERE NOT good) AS failed,
         count(*) FILTER (WHERE good) * 100.0::DOUBLE / count(*) AS success_rate FROM rec GROUP BY 1""",
    "rec",
)
def source_stats(spark, folder):
    checked = quality.parsed(t.raw_records(spark, folder)).select(
        F.col("log_type").alias("source"), quality.is_valid().alias("ok")
    )
    return quality.source_statistics(checked, "source", F.col("ok"))


# Metrics, alarms and capacity.


QUALITY_METRICS = {
    "total_records": ("TotalRecords", "Count"),
    "valid_records": ("ValidRecords", "Count"),
    "invalid_records": ("InvalidRecords", "Count"),
    "quality_rate": ("DataQualityRate", "Percent"),
}
POINTS = f"""SELECT 'DataQuality/Streaming' AS namespace, "at", metric, value, unit FROM (
  SELECT time_bucket(INTERVAL 1 MINUTE, received_at) AS "at", {METRICS} FROM rec GROUP BY 1) q, LATERAL (VALUES
    ('TotalRecords', CAST(q.total_records AS DOUBLE), 'Count'), ('ValidRecords', CAST(q.valid_records AS DOUBLE), 'Count'),
    ('InvalidRecords', CAST(q.invalid_records AS DOUBLE), 'Count'), ('DataQualityRate', q.quality_rate, 'Percent'))
    v(metric, value, unit)"""


def points(spark, folder):
    per_minute = quality.quality_metrics(t.raw_records(spark, folder), "received_at", "1 minute")
    return metrics.metric_table(per_minute, "DataQuality/Streaming", "window_start", QUALITY_METRICS, [])


@query("metric_table", POINTS, "rec")
def metric_table(spark, folder):
    return points(spark, folder)


@query(
    "log_metrics",
    """SELECT 'Logs' AS namespace, time_bucket(INTERVAL 1 MINUTE, "timestamp") AS "at", metric,
         sum(CASE metric WHEN 'Failures' THEN CAST(event_type = 'error' AS INTEGER) WHEN 'LowCodes' THEN CAST(k % 5 < 2 AS INTEGER)
           ELSE k % 5 END)::DOUBLE AS value, CASE metric WHEN 'Codes' THEN 'None' ELSE 'Count' END AS unit
       FROM ev, (VALUES ('Failures'), ('LowCodes'), ('Codes')) v(metric)
       WHERE level <> 'DEBUG' AND (metric = 'Codes' OR (metric = 'Failures' AND event_type = 'error') OR (metric = 'LowCodes' AND k % 5 < 2))
       GROUP BY 2, 3""",
    "ev",
)
def log_metrics(spark, folder):
    """Points from log messages by pattern: lines that report an error, lines with a low code, and the codes added up."""
    patterns = {"Failures": "^error ", "LowCodes": " [01]$", "Codes": " ([0-9]+)$"}
    logs = t.events(spark, folder)
    return metrics.pattern_points(logs, "Logs", "timestamp", "message", patterns, where=F.col("level") != "DEBUG")


STATS = f"""SELECT namespace, metric, time_bucket(INTERVAL 5 MINUTE, "at") AS period_start, round(sum(value), 6) AS sum,
  round(avg(value), 6) AS average, min(value) AS minimum, max(value) AS maximum, count(*) AS samples
  FROM ({POINTS}) GROUP BY 1, 2, 3"""


def statistics(spark, folder):
    out = metrics.metric_statistics(points(spark, folder), "300 seconds")
    return out.withColumns({c: F.round(c, 6) for c in ("sum", "average")})


@query("metric_stats", STATS, "rec")
def metric_stats(spark, folder):
    return statistics(spark, folder)


def statistics_by_type(spark, folder):
    per_minute = quality.quality_metrics(t.raw_records(spark, folder), "received_at", "1 minute", dimensions=["log_type"])
    table = metrics.metric_table(per_minute, "DataQuality/Streaming", "window_start", QUALITY_METRICS, ["log_type"])
    out = metrics.metric_statistics(table, "300 seconds", ["log_type"])
    return out.withColumns({c: F.round(c, 6) for c in ("sum", "average")})


BY_TYPE = f"""SELECT 'DataQuality/Streaming' AS namespace, metric, log_type, time_bucket(INTERVAL 5 MINUTE, "at") AS period_start,
  round(sum(value), 6) AS sum, round(avg(value), 6) AS average FROM (
    SELECT "at", log_type, metric, value FROM (
      SELECT time_bucket(INTERVAL 1 MINUTE, received_at) AS "at", log_type, {METRICS} FROM rec GROUP BY 1, 2) q, LATERAL (VALUES
        ('InvalidRecords', CAST(q.invalid_records AS DOUBLE)), ('DataQualityRate', q.quality_rate)) v(metric, value))
  GROUP BY ALL"""


@query(
    "alarms",
    f"""WITH s AS ({BY_TYPE}), r AS (
          SELECT 'High-Invalid-Data' AS alarm, namespace, metric, log_type, period_start, sum AS value, sum > 1 AS breach, 1 AS k
            FROM s WHERE metric = 'InvalidRecords'
          UNION ALL
          SELECT 'Low-Data-Quality-Rate', namespace, metric, log_type, period_start, average, average < 80, 2
            FROM s WHERE metric = 'DataQualityRate')
        SELECT a.alarm, a.namespace, a.metric, a.log_type, a.period_start, any_value(a.value) AS value,
          CASE WHEN count(*) FILTER (WHERE b.breach) >= any_value(a.k) THEN 'ALARM' ELSE 'OK' END AS state
        FROM r a JOIN r b ON a.alarm = b.alarm AND a.log_type = b.log_type
          AND b.period_start BETWEEN a.period_start - to_seconds(300 * (a.k - 1)) AND a.period_start
        GROUP BY ALL""",
    "rec",
)
def alarms(spark, folder):
    """Both alarms for each kind of log; a period without records breaks a row of breaches."""
    rules = [
        metrics.AlarmRule("High-Invalid-Data", "InvalidRecords", "sum", "GreaterThanThreshold", 1),
        metrics.AlarmRule("Low-Data-Quality-Rate", "DataQualityRate", "average", "LessThanThreshold", 80, periods=2),
    ]
    return metrics.alarm_table(statistics_by_type(spark, folder), rules, dimensions=["log_type"])


@query(
    "alarm_levels",
    """SELECT hour, quality_rate, CASE WHEN quality_rate < 90 THEN 'CRITICAL' WHEN quality_rate < 95 THEN 'WARNING'
         ELSE 'OK' END AS level FROM (
           SELECT date_trunc('hour', received_at) AS hour,
             count(*) FILTER (WHERE good) * 100.0::DOUBLE / count(*) AS quality_rate FROM rec GROUP BY 1)""",
    "rec",
)
def alarm_levels(spark, folder):
    per_hour = quality.quality_metrics(t.raw_records(spark, folder), "received_at", "1 hour")
    return per_hour.select(
        F.col("window_start").alias("hour"), "quality_rate", metrics.rate_level("quality_rate").alias("level")
    )


@query(
    "key_balance",
    """WITH keys AS (
         SELECT 'user' AS strategy, CAST(user_id AS VARCHAR) AS key FROM ev
         UNION ALL SELECT 'hash', md5(CAST(event_id AS VARCHAR)) FROM ev
         UNION ALL SELECT 'time', strftime("timestamp", '%H') || '_' || lpad(CAST(minute("timestamp") // 6 AS VARCHAR), 2, '0') FROM ev
         UNION ALL SELECT 'composite', user_id || '_' || category FROM ev),
       random AS (SELECT 'random' AS strategy, NULL AS bucket, count(*) AS records, 100.0::DOUBLE AS percentage, NULL AS variation FROM ev),
       counted AS (SELECT strategy, bucket, count(key) AS records FROM
         (SELECT strategy, key, CAST(('0x' || substr(md5(key), 32, 1)) AS INTEGER) % 4 AS bucket FROM keys) GROUP BY 1, 2)
       SELECT strategy, bucket, coalesce(records, 0) AS records,
         coalesce(records, 0) * 100.0::DOUBLE / CAST(sum(coalesce(records, 0)) OVER w AS DOUBLE) AS percentage,
         round(stddev_pop(coalesce(records, 0)) OVER w / avg(coalesce(records, 0)) OVER w * 100, 6) AS variation
       FROM (SELECT * FROM (SELECT DISTINCT strategy FROM keys) CROSS JOIN (SELECT CAST(unnest(range(4)) AS INTEGER) AS bucket)) a
       LEFT JOIN counted USING (strategy, bucket) WINDOW w AS (PARTITION BY strategy)
       UNION ALL SELECT * FROM random""",
    "ev",
)
def key_balance(spark, folder):
    """All strategies; the buckets of random keys differ in every run, so they are added up."""
    out = metrics.key_balance(t.events(spark, folder), metrics.key_strategies())
    stable = out.filter("strategy <> 'random'").withColumn("variation", F.round("variation", 6))
    random = out.filter("strategy = 'random'").groupBy("strategy").agg(F.sum("records").alias("records"), F.round(F.sum("percentage"), 6).alias("percentage"))
    return stable.unionByName(random, allowMissingColumns=True)


@query(
    "capacity",
    """SELECT mb_per_second, records_per_second, CAST(ceil(mb_per_second) AS BIGINT) AS throughput_based,
         CAST(ceil(records_per_second / 1000.0) AS BIGINT) AS records_based, k AS partition_based,
         greatest(CAST(ceil(mb_per_second) AS BIGINT), CAST(ceil(records_per_second / 1000.0) AS BIGINT), k) AS minimum_partitions,
         CAST(ceil(greatest(CAST(ceil(mb_per_second) AS BIGINT), CAST(ceil(records_per_second / 1000.0) AS BIGINT), k)
           * 1.2::DOUBLE) AS BIGINT) AS recommended_partitions
       FROM (SELECT max(b) / 1048576.0::DOUBLE AS mb_per_second, max(n) AS records_per_second,
               (SELECT count(DISTINCT category) FROM ev) AS k
             FROM (SELECT date_trunc('second', "timestamp") AS s, sum(response_size) AS b, count(*) AS n FROM ev GROUP BY 1))""",
    "ev",
)
def capacity(spark, folder):
    return metrics.capacity_report(t.events(spark, folder), "timestamp", F.col("response_size"), "category")


@query(
    "scale_advice",
    """SELECT period_start, load AS mb_per_partition,
         CASE WHEN load > 1e-5 THEN 'scale_out' WHEN load < 3e-6 THEN 'scale_in' ELSE 'hold' END AS action,
         CASE WHEN load > 1e-5 THEN 8 WHEN load < 3e-6 THEN 2 ELSE 4 END AS target_partitions
       FROM (SELECT time_bucket(INTERVAL 5 MINUTE, "timestamp") AS period_start,
               CAST(sum(response_size) AS DOUBLE) / 300.0::DOUBLE / 1048576.0::DOUBLE / 4.0::DOUBLE AS load FROM ev GROUP BY 1)""",
    "ev",
)
def scale_advice(spark, folder):
    """The limits are set for the small flow of the test data."""
    per_period = t.events(spark, folder).groupBy(F.window("timestamp", "5 minutes").alias("w")).agg(
        (F.sum("response_size").cast("double") / 300.0).alias("rate")
    )
    advice = metrics.scale_advice(F.col("rate"), F.lit(4), out_mb=1e-5, in_mb=3e-6)
    return per_period.select(F.col("w.start").alias("period_start"), *advice)
