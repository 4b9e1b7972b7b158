"""Writers and stream sinks: each query writes or replays a given table and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sluice.functions.values import rows, total
from sluice.operators import quality, sessions
from sluice.plans import analytics, lake
from sluice.queries.analyses import LIVE_SQL, SCORES
from sluice.queries.registry import query
from sluice.queries.streams import MEAN, PATHS, SCORED, TOTAL, bucket
from sluice.session import scratch_path
from sluice.sources import datasets, readers, writers
from sluice.sources import tables as t
from sluice.streaming import closed, deviation, progress, sinks, source, windows

SLIM = "event_id BIGINT, timestamp TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, amount DOUBLE, category STRING"
COLUMNS = [part.split()[0] for part in SLIM.split(", ")]


def slim(spark, folder):
    return t.events(spark, folder).select(*COLUMNS)


@query(
    "write_hourly",
    """SELECT event_id, "timestamp", amount, strftime("timestamp", '%Y') AS year, strftime("timestamp", '%m') AS month,
         strftime("timestamp", '%d') AS day, strftime("timestamp", '%H') AS hour FROM ev""",
    "ev",
)
def write_hourly(spark, folder):
    root = scratch_path(spark, "hourly")
    writers.write_partitioned(slim(spark, folder), root, "timestamp", "hour", "json")
    return readers.read_partitioned(spark, root, SLIM).drop("user_id", "event_type", "category")


@query(
    "write_daily",
    """SELECT event_id, amount, strftime("timestamp", '%Y') AS year, strftime("timestamp", '%m') AS month,
         strftime("timestamp", '%d') AS day FROM ev""",
    "ev",
)
def write_daily(spark, folder):
    root = scratch_path(spark, "daily")
    writers.write_partitioned(slim(spark, folder), root, "timestamp", "day", "json")
    back = readers.read_partitioned(spark, root, SLIM, granularity="day")
    return back.select("event_id", "amount", "year", "month", "day")


@query("write_parquet", """SELECT event_id, amount, category FROM ev""", "ev")
def write_parquet(spark, folder):
    root = scratch_path(spark, "by-category")
    writers.write_parquet(slim(spark, folder), root, files=3, partition_by=("category",))
    return readers.read_parquet(spark, root).select("event_id", "amount", "category")


@query(
    "write_by_region",
    """SELECT event_id, category, CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month FROM ev""",
    "ev",
)
def write_by_region(spark, folder):
    root = scratch_path(spark, "regions")
    writers.write_by_region(slim(spark, folder), root, "timestamp", "category")
    return readers.read_parquet(spark, root).select("event_id", "category", "year", "month")


@query(
    "codec_policy",
    """SELECT u AS use, count(*) AS records, CAST(sum(m) AS DOUBLE) AS amount
       FROM ev, (VALUES ('realtime'), ('batch'), ('archive')) v(u) GROUP BY 1""",
    "ev",
)
def codec_policy(spark, folder):
    """The same rows by every codec of the policy."""
    out = None
    for use in ("realtime", "batch", "archive"):
        path, fmt = scratch_path(spark, use), "json" if use == "archive" else "parquet"
        writers.write_for(slim(spark, folder), path, use, fmt)
        back = spark.read.schema(SLIM).options(**readers.MICROS).format(fmt).load(path)
        line = back.agg(rows().alias("records"), total("amount").alias("amount")).select(F.lit(use).alias("use"), "records", "amount")
        out = line if out is None else out.union(line)
    return out


@query(
    "rerun_day",
    """SELECT strftime("timestamp", '%Y-%m-%d') AS day, count(*) AS records,
         CAST(sum(CASE WHEN CAST("timestamp" AS DATE) = DATE '2024-01-15' THEN 2 * m ELSE m END) AS DOUBLE) AS amount FROM ev GROUP BY 1""",
    "ev",
)
def rerun_day(spark, folder):
    """One day is written again with doubled amounts; the other days keep their files."""
    root = scratch_path(spark, "rerun")
    days = slim(spark, folder).withColumn("day", F.date_format("timestamp", "yyyy-MM-dd"))
    writers.replace_partitions(days, root, ["day"])
    writers.replace_partitions(days.filter("day = '2024-01-15'").withColumn("amount", F.col("amount") * 2), root, ["day"])
    back = spark.read.schema(f"{SLIM}, day STRING").parquet(root)
    return back.groupBy("day").agg(rows().alias("records"), total("amount").alias("amount"))


@query("split_sinks", "SELECT event_id, good FROM rec", "rec")
def split_sinks(spark, folder):
    """Good records and dead letters in their own places."""
    good_path, bad_path = scratch_path(spark, "good"), scratch_path(spark, "bad")
    good, bad = quality.good_and_bad(t.raw_records(spark, folder), F.lit("2024-02-01").cast("timestamp_ntz"))
    writers.write_split(good.select("event_id"), bad.select("event_id"), good_path, bad_path)
    kept = spark.read.parquet(good_path).select("event_id", F.lit(True).alias("good"))
    return kept.union(spark.read.schema("event_id BIGINT").json(bad_path).select("event_id", F.lit(False)))


@query(
    "join_full_rows",
    """SELECT c_custkey AS user_id, o_orderkey AS order_id, c_custkey IS NULL AS no_user, o_orderkey IS NULL AS no_order
       FROM customer FULL JOIN (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN -o_custkey ELSE o_custkey END AS k FROM orders) ON c_custkey = k""",
)
def join_full_rows(spark, folder):
    """All users against all orders, row by row. Urgent orders are booked on accounts that are no users, so both sides have rows without a match."""
    users = t.users(spark, folder).select("user_id")
    raw = readers.read_parquet(spark, f"{folder}/orders.parquet")
    account = F.when(F.col("o_orderpriority") == "1-URGENT", -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    orders = raw.select(account.alias("account"), F.col("o_orderkey").alias("order_id"))
    both = users.join(orders, users["user_id"] == orders["account"], "full")
    return both.select("user_id", "order_id", F.col("user_id").isNull().alias("no_user"), F.col("order_id").isNull().alias("no_order"))


# Streams. The table arrives in deliveries, and the stream runs after each on one checkpoint.


STREAM = SLIM.replace("TIMESTAMP_NTZ", "TIMESTAMP") + ", session_id STRING"
HALF = "2024-01-15"


def deliveries(spark, folder):
    """The events by half months, rows without a time with the first, then a row far in the future, which closes every window."""
    table = t.events(spark, folder).select(*COLUMNS, "session_id").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    last = table.limit(1).withColumns({"timestamp": F.lit("2030-01-01").cast("timestamp"), "event_id": F.lit(-1).cast("bigint")})
    late = F.coalesce(F.col("timestamp") >= F.lit(HALF).cast("timestamp"), F.lit(False))
    return [table.filter(~late), table.filter(late), last]


def replay(spark, parts, start, delay="5 seconds", schema=STREAM):
    """Write one part after the other below a fresh path, and after each run the stream until it has read it.

    ``start`` takes the watermarked stream and the checkpoint, and starts a query.
    """
    path, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "cp")
    for n, part in enumerate(parts):
        part.write.parquet(f"{path}/part={n}")
        stream = windows.watermarked(source.file_stream(spark, f"{path}/*", schema), "timestamp", delay)
        ended(start(stream, checkpoint))


def ended(running):
    running.awaitTermination()
    if running.exception():
        raise RuntimeError(str(running.exception()))


def ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query(
    "stream_windows",
    f"""SELECT {bucket(5)}, event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
          {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev WHERE amount IS NOT NULL GROUP BY 1, 2, 3""",
    "ev",
)
def stream_windows(spark, folder):
    """Watermarked windows appended as files: the stream gives what the table gives."""
    return windowed(spark, folder, windows.by_type)


def windowed(spark, folder, form):
    out = scratch_path(spark, "windows")
    replay(spark, deliveries(spark, folder), lambda stream, cp: sinks.append_rows(form(stream), out, cp, "parquet"))
    return ntz(spark.read.parquet(out).filter("window_start < '2029-01-01'"), "window_start", "window_end")


@query(
    "stream_users",
    f"""SELECT {bucket(5)}, user_id, count(*) AS event_count, count(DISTINCT session_id) AS sessions,
          {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev WHERE user_id IS NOT NULL GROUP BY 1, 2, 3""",
    "ev",
)
def stream_users(spark, folder):
    """Different sessions of a user, counted by two aggregations of a stream."""
    return windowed(spark, folder, windows.by_user)


@query(
    "stream_logs",
    f"""SELECT {bucket(1)}, log_type, count(*) AS request_count, count(DISTINCT ip_address) AS unique_ips,
          CAST(sum(response_size) AS DOUBLE) / count(response_size) AS avg_response_size FROM ev GROUP BY 1, 2, 3""",
    "ev",
)
def stream_logs(spark, folder):
    """Different addresses of a minute, counted by two aggregations of a stream."""
    columns = ["timestamp", "log_type", "ip_address", "response_size"]
    logs = t.events(spark, folder).select(*columns).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    last = logs.limit(1).withColumn("timestamp", F.lit("2030-01-01").cast("timestamp"))
    out = scratch_path(spark, "windows")
    schema = "timestamp TIMESTAMP, log_type STRING, ip_address STRING, response_size INT"
    replay(spark, [logs, last], lambda stream, cp: sinks.append_rows(windows.by_log_type(stream), out, cp, "parquet"), schema=schema)
    return ntz(spark.read.parquet(out).filter("window_start < '2029-01-01'"), "window_start", "window_end")


@query(
    "stream_restart",
    f"""SELECT {bucket(5)}, user_id, count(*) AS event_count, count(DISTINCT session_id) AS sessions,
          {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev WHERE user_id IS NOT NULL GROUP BY 1, 2, 3""",
    "ev",
)
def stream_restart(spark, folder):
    """The stream is started again on its checkpoint with every delivery; rows that come twice a year later close nothing twice."""
    parts, out = deliveries(spark, folder), scratch_path(spark, "restart")
    again = parts[2].withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 YEAR"))
    replay(spark, [*parts, again], lambda stream, cp: sinks.append_rows(windows.by_user(stream), out, cp, "parquet"))
    return ntz(spark.read.parquet(out).filter("window_start < '2029-01-01'"), "window_start", "window_end")


@query(
    "stream_folders",
    """SELECT event_id, amount, strftime("timestamp", '%Y-%m-%d') AS date FROM ev""",
    "ev",
)
def stream_folders(spark, folder):
    """A stream delivered into day folders."""
    out = scratch_path(spark, "folders")
    replay(spark, deliveries(spark, folder), lambda stream, cp: sinks.deliver(stream, out, cp, "timestamp", "day"))
    back = spark.read.schema(f"{STREAM}, year STRING, month STRING, day STRING").options(**readers.MICROS).json(out)
    return back.filter("event_id >= 0").select("event_id", "amount", F.concat_ws("-", "year", "month", "day").alias("date"))


@query("stream_once", "SELECT event_id, event_type FROM ev", "ev")
def stream_once(spark, folder):
    """Events that come twice pass once."""
    first, second, last = deliveries(spark, folder)
    out = scratch_path(spark, "once")
    start = lambda stream, cp: sinks.append_rows(sinks.without_duplicates(stream, "event_id"), out, cp, "parquet")
    replay(spark, [first, second, first.union(second), last], start, "60 days")
    return spark.read.parquet(out).filter("event_id >= 0").select("event_id", "event_type")


@query("stream_split", "SELECT event_id, good FROM rec", "rec")
def stream_split(spark, folder):
    """A stream of raw records into good ones and dead letters."""
    raw, path = t.raw_records(spark, folder), scratch_path(spark, "raw-feed")
    raw.write.parquet(path)
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    schema = "event_id BIGINT, received_at TIMESTAMP_NTZ, log_type STRING, record STRING"
    ended(sinks.split_records(source.file_stream(spark, path, schema), "received_at", good, bad, scratch_path(spark, "cp")))
    kept = spark.read.parquet(good).select("event_id", F.lit(True).alias("good"))
    return kept.union(spark.read.schema("event_id BIGINT").json(bad).select("event_id", F.lit(False)))


@query(
    "stream_new_files",
    """SELECT strftime("timestamp", '%Y-%m-%d') AS day, strftime("timestamp", '%H') AS hour, count(*) AS events,
         count(DISTINCT user_id) AS users FROM ev GROUP BY 1, 2""",
    "ev",
)
def stream_new_files(spark, folder):
    """Every new file is added to the lake, and the report of just its hours is made again."""
    store, out = scratch_path(spark, "store"), scratch_path(spark, "report")

    def report(df):
        return df.groupBy("day", "hour").agg(rows().alias("events"), F.countDistinct("user_id").alias("users"))

    def start(stream, cp):
        return sinks.rerun_touched_hours(stream.filter("event_id >= 0"), "timestamp", store, STREAM, report, out, cp)

    replay(spark, deliveries(spark, folder)[:2], start)
    return spark.read.schema("events BIGINT, users BIGINT, day STRING, hour STRING").parquet(out)


@query(
    "stream_anomalies",
    f"""SELECT event_id, user_id, event_type, amount, mu AS moving_mean, round(score, 6) AS anomaly_score,
          coalesce(score > 2, false) AS is_anomaly FROM ({SCORED})""",
    "ev",
)
def stream_anomalies(spark, folder):
    """Every event of a stream against the hour before it; the second delivery brings rows of the first half late, but within the delay."""
    first, second, last = deliveries(spark, folder)
    store, out = scratch_path(spark, "store"), scratch_path(spark, "scores")
    held = F.pmod(F.col("event_id"), F.lit(3)) == 0
    parts = [first.filter(~held), first.filter(held).union(second), last]

    def start(stream, cp):
        return deviation.score_stream(stream, store, out, cp, limit=2.0, delay_seconds=20 * 86_400)

    replay(spark, parts, start)
    back = spark.read.parquet(out).filter("event_id >= 0")
    return back.select("event_id", "user_id", "event_type", "amount", "moving_mean", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly")


@query(
    "stream_alerts",
    f"""SELECT "timestamp", 'ANOMALY_DETECTED' AS alert_type, event_type, round(score, 6) AS anomaly_score,
          amount AS current_value, mu AS expected_range FROM ({SCORED}) WHERE score > 2""",
    "ev",
)
def stream_alerts(spark, folder):
    """Alert rows of a stream."""
    store, out = scratch_path(spark, "store"), scratch_path(spark, "alerts")
    replay(spark, deliveries(spark, folder), lambda stream, cp: deviation.alert_stream(stream, store, out, cp, limit=2.0))
    return ntz(spark.read.parquet(out).drop("batch"), "timestamp").withColumn("anomaly_score", F.round("anomaly_score", 6))


@query("stream_paths", PATHS, "ev")
def stream_paths(spark, folder):
    """Event paths of a stream, written once their window has ended."""
    store, out = scratch_path(spark, "store"), scratch_path(spark, "paths")

    def start(stream, cp):
        return deviation.path_stream(stream.filter("event_id >= 0 OR timestamp > '2029-01-01'"), store, out, cp, lambda df: sessions.behavior_paths(df, segment=2))

    replay(spark, deliveries(spark, folder), start)
    return ntz(spark.read.parquet(out).filter("window_start < '2029-01-01'").drop("batch"), "window_start")


@query(
    "stream_late",
    """SELECT event_id, "timestamp" < '2024-01-15' AS late, CASE WHEN "timestamp" < '2024-01-15' THEN
         (SELECT epoch_us(max("timestamp")) FROM ev) - 5000000 - epoch_us("timestamp") END AS late_us FROM ev""",
    "ev",
)
def stream_late(spark, folder):
    """The first half of the month comes after the second: its rows are late, kept apart with their delay."""
    first, second, last = deliveries(spark, folder)
    store, out = scratch_path(spark, "store"), scratch_path(spark, "kept")

    def start(stream, cp):
        return closed.closed_batches(stream, "timestamp", store, lambda rows, n: sinks.write_batch(rows, out, n), cp)

    replay(spark, [second, first, last], start)
    late = closed.late_rows(spark, store, second).select("event_id", F.lit(True).alias("late"), "late_us")
    kept = spark.read.parquet(out).select("event_id", F.lit(False).alias("late"), F.lit(None).cast("bigint").alias("late_us"))
    return kept.union(late)


@query("stream_scores", SCORES, "ev")
def stream_scores(spark, folder):
    """Decayed interest of a stream; the second delivery brings late rows of the first hours."""
    first, second, last = (part.filter("event_id >= 0 OR timestamp > '2029-01-01'") for part in deliveries(spark, folder))
    out, held = scratch_path(spark, "scores"), F.pmod(F.col("event_id"), F.lit(3)) == 0
    parts = [first.filter(~held), first.filter(held).union(second), last]
    replay(spark, parts, lambda stream, cp: sinks.append_rows(analytics.behavior_score(stream), out, cp, "parquet"), "20 days")
    back = spark.read.parquet(out).filter("window.start < '2029-01-01'")
    return ntz(
        back.select(
            F.col("window.start").alias("window_start"), "user_id", "category", F.round("behavior_score", 8).alias("behavior_score"), "last_activity"
        ),
        "window_start", "last_activity",
    )


@query("stream_live", LIVE_SQL, "ev")
def stream_live(spark, folder):
    """The metrics of the latest day of a stream, as they stand after the last batch."""
    first, second, _ = deliveries(spark, folder)
    store, out = scratch_path(spark, "store"), scratch_path(spark, "live")
    late = F.pmod(F.col("event_id"), F.lit(5)) == 0
    parts = [first.union(second.filter(~late)), second.filter(late)]
    replay(spark, parts, lambda stream, cp: sinks.live_day(stream, "timestamp", store, out, cp), "20 days")
    return spark.read.parquet(out).drop("day")


@query(
    "consumer_lag",
    """WITH batches AS (
         SELECT least(datediff('day', DATE '2024-01-01', CAST("timestamp" AS DATE)) // 7, 4) AS batch_id, max("timestamp") AS "at", count(*) AS n
         FROM ev GROUP BY 1),
       periods AS (
         SELECT CAST(TIMESTAMP '1970-01-01' + to_days(CAST(7 * (epoch_us("at") // 604800000000) AS INTEGER)) AS TIMESTAMP) AS period_start,
           CAST(max(epoch_us((SELECT max("timestamp") FROM ev)) // 1000 - epoch_us("at") // 1000) AS DOUBLE) AS value FROM batches GROUP BY 1)
       SELECT period_start, value, CASE WHEN value > 60000 AND lag(value) OVER w > 60000
           AND lag(period_start) OVER w = period_start - INTERVAL 7 DAY THEN 'ALARM' ELSE 'OK' END AS state,
         (SELECT sum(n) FROM batches)::BIGINT AS rows_read
       FROM periods WINDOW w AS (ORDER BY period_start)""",
    "ev",
)
def consumer_lag(spark, folder):
    """A stream reads one week after the other and reports how far it is behind the newest event; two weeks in a row are an alarm."""
    table = t.events(spark, folder).select(*COLUMNS, "session_id").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    week = F.least(F.floor(F.datediff("timestamp", F.lit("2024-01-01")) / 7), F.lit(4))
    out = scratch_path(spark, "read")
    with progress.ProgressLog(spark) as log:

        def start(stream, cp):
            running = sinks.append_rows(stream, out, cp, "parquet")
            log.wait(running)
            return running

        replay(spark, [table.filter(week == n) for n in range(5)], start)
    behind = progress.lag_behind(log.table(), table, "timestamp")
    read = behind.agg(F.sum("input_rows")).scalar()
    states = sinks.lag_alarms(behind, 7 * 86_400)
    return ntz(states.select("period_start", "value", "state", read.alias("rows_read")), "period_start")


@query(
    "dataset_refresh",
    """SELECT step, category, count(*) AS records, CAST(sum(m) AS DOUBLE) AS amount FROM ev, (VALUES (1), (2)) v(step)
       WHERE step = 2 OR "timestamp" < '2024-01-15' GROUP BY 1, 2""",
    "ev",
)
def dataset_refresh(spark, folder):
    """A data set in memory, asked twice before and once after its files change."""
    table, path, name = slim(spark, folder), scratch_path(spark, "dataset"), "refreshed_" + uuid.uuid4().hex[:8]
    half = F.col("timestamp") < F.lit(HALF).cast("timestamp_ntz")

    def asked(step):
        held = datasets.in_memory(spark, name, path)
        told = held.groupBy("category").agg(rows().alias("records"), total("amount").alias("amount"))
        return told.select(F.lit(step).alias("step"), "category", "records", "amount").collect()

    table.filter(half).write.parquet(path)
    first = asked(1)
    assert asked(1) == first or sorted(asked(1)) == sorted(first)
    table.filter(~half).write.mode("append").parquet(path)
    both = [*first, *asked(2)]
    datasets.release(spark, name)
    return spark.createDataFrame(both, "step INT, category STRING, records BIGINT, amount DOUBLE")
