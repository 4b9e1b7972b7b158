"""Streams against their table forms, with late, repeated and closing rows, and restarts."""

from __future__ import annotations

import datetime as dt

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from sluice.operators import sessions as runs
from sluice.plans import analytics
from sluice.sources import datasets
from sluice.sources import tables as t
from sluice.streaming import closed, deviation, progress, sinks, source, windows
from sluice.streaming.sessions import stateful_sessions

COLUMNS = [
    "event_id", "timestamp", "user_id", "event_type", "amount", "session_id", "ip_address", "log_type", "response_size",
]
SCHEMA = (
    "event_id BIGINT, timestamp TIMESTAMP, user_id BIGINT, event_type STRING, amount DOUBLE, session_id STRING, "
    "ip_address STRING, log_type STRING, response_size INT"
)


def events(spark):
    return t.events(spark, SMALL).select(*COLUMNS).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def put(df, path, name):
    """One file (or few) per call; the name gives the order in which the stream reads."""
    df.coalesce(1).write.mode("append").parquet(f"{path}/part={name}")


def closing(spark):
    """A row far in the future, which closes every window before it."""
    row = (-1, dt.datetime(2030, 1, 1), -1, "purchase", 0.0, "end", "end", "end", 0)
    return spark.createDataFrame([row], SCHEMA)


@pytest.fixture
def feed(spark, folder):
    """The events in two files by time, then the closing row."""
    path = f"{folder}/feed"
    half = F.lit("2024-01-15").cast("timestamp")
    put(events(spark).filter(F.col("timestamp") < half), path, "1")
    put(events(spark).filter(F.col("timestamp") >= half), path, "2")
    put(closing(spark), path, "3")
    return path


def stream(spark, path, delay="5 seconds"):
    raw = source.file_stream(spark, f"{path}/*", SCHEMA, files_per_trigger=1)
    return windows.watermarked(raw, "timestamp", delay)


def finish(query):
    query.awaitTermination(240)
    assert query.exception() is None
    return query


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "form",
    [
        windows.by_type,
        windows.by_user,
        windows.by_log_type,
        lambda df: windows.frequent_purchases(df, more_than=0, medium=1, high=2),
        lambda df: windows.counts(df, F.col("event_type") == "purchase"),
    ],
)
def test_window_stream_equals_table(spark, folder, feed, form):
    out = f"{folder}/out"
    finish(sinks.append_rows(form(stream(spark, feed)), out, f"{folder}/cp", "parquet"))
    expected = form(events(spark))
    got = spark.read.parquet(out).filter(F.col("window_start") < F.lit("2029-01-01").cast("timestamp"))
    assert collected(got.select(*expected.columns)) == collected(expected)


def test_session_stream_equals_table(spark, folder, feed):
    finish(sinks.append_rows(windows.sessions(stream(spark, feed)), f"{folder}/out", f"{folder}/cp", "parquet"))
    got = spark.read.parquet(f"{folder}/out").filter("user_id >= 0")
    expected = runs.sessions(events(spark), "user_id", "timestamp", "amount", "event_type")
    assert collected(got.select(*expected.columns)) == collected(expected)


def test_stateful_sessions_equal_table(spark, folder, feed):
    out = stateful_sessions(stream(spark, feed))
    finish(sinks.append_rows(out, f"{folder}/out", f"{folder}/cp", "parquet"))
    got = spark.read.parquet(f"{folder}/out").filter("user_id >= 0")
    expected = runs.sessions(events(spark), "user_id", "timestamp", "amount", "event_type").withColumn(
        "event_types", F.array_join("event_types", ",")
    )
    assert collected(got.select(*expected.columns)) == collected(expected)


def mixed_up(spark, path):
    """The events so that each delivery brings rows of the one before it late, but within twenty days."""
    half = F.lit("2024-01-15").cast("timestamp")
    held = F.pmod(F.col("event_id"), F.lit(4)) == 0
    first, second = events(spark).filter(F.col("timestamp") < half), events(spark).filter(F.col("timestamp") >= half)
    put(first.filter(~held), path, "1")
    put(first.filter(held).union(second.filter(~held)), path, "2")
    put(second.filter(held), path, "3")
    put(closing(spark), path, "4")


def test_deviation_stream_equals_table(spark, folder):
    mixed_up(spark, f"{folder}/feed")
    raw = stream(spark, f"{folder}/feed")
    finish(deviation.score_stream(raw, f"{folder}/store", f"{folder}/out", f"{folder}/cp", limit=2.0, delay_seconds=20 * 86_400))
    got = spark.read.parquet(f"{folder}/out").filter("event_id >= 0")
    columns = [*COLUMNS, "moving_count", "moving_mean", "anomaly_score", "is_anomaly"]
    expected = windows.hourly_deviation(events(spark), limit=2.0)
    assert collected(got.select(*columns)) == collected(expected.select(*columns))


def test_alert_stream_equals_table(spark, folder):
    base = dt.datetime(2024, 1, 1)
    rows = [(n, base + dt.timedelta(seconds=7 * n), 1, "click", 1000.0 if n % 50 == 49 else float(n % 3), "s", "a", "l", 0) for n in range(400)]
    put(spark.createDataFrame(rows[::2], SCHEMA), f"{folder}/feed", "1")
    put(spark.createDataFrame(rows[1::2], SCHEMA), f"{folder}/feed", "2")
    put(closing(spark), f"{folder}/feed", "3")
    raw = stream(spark, f"{folder}/feed")
    finish(deviation.alert_stream(raw, f"{folder}/store", f"{folder}/out", f"{folder}/cp", limit=3.0, delay_seconds=3600))
    expected = windows.alerts(windows.hourly_deviation(spark.createDataFrame(rows, SCHEMA), limit=3.0))
    assert expected.count() >= 5
    assert collected(spark.read.parquet(f"{folder}/out").select(*expected.columns)) == collected(expected)


def test_path_stream_equals_table(spark, folder, segment=1000):
    base = dt.datetime(2024, 1, 20, 12)
    kinds = ["view", "review", "click", "x", "purchase"]
    long = [(10_000 + n, base + dt.timedelta(seconds=n / 4), 999, kinds[(n // 700) % 5], 1.0, "long", "a", "l", 0) for n in range(3000)]
    put(spark.createDataFrame(long[::-1], SCHEMA), f"{folder}/feed", "0")
    mixed_up(spark, f"{folder}/feed")
    form = lambda df: runs.behavior_paths(df, segment=segment)
    finish(deviation.path_stream(stream(spark, f"{folder}/feed"), f"{folder}/store", f"{folder}/out", f"{folder}/cp", form, delay_seconds=20 * 86_400))
    expected = form(events(spark).union(spark.createDataFrame(long, SCHEMA)))
    got = spark.read.parquet(f"{folder}/out").filter("user_id >= 0")
    assert collected(got.select(*expected.columns)) == collected(expected)
    assert got.filter("session_id = 'long'").count() == 3000 // segment


def test_stored_hours_are_forgotten_and_batches_can_come_again(spark, folder, feed):
    store, seen = f"{folder}/store", []

    def work(rows, batch_id):
        seen.append((batch_id, rows.filter(closed.OWN).count(), rows.filter(~F.col(closed.OWN)).count()))
        if len(seen) == 2:
            raise RuntimeError("lost")

    def run():
        return closed.closed_batches(stream(spark, feed), "timestamp", store, work, f"{folder}/cp", lookback_seconds=3600)

    query = run()
    with pytest.raises(Exception):
        query.awaitTermination(240)
    finish(run())
    ids = [b for b, _, _ in seen]
    assert ids == [0, 1, 1, 2] and seen[1] == seen[2]
    # The latest rows stand at the watermark, and the closing row closes them.
    assert sum(own for _, own, _ in [seen[0], *seen[2:]]) == events(spark).count()
    hours = [p for p in (path.name for path in (__import__("pathlib").Path(store) / "rows" / "late=false").iterdir()) if p.startswith("hour=")]
    assert 0 < len(hours) < 60


def test_late_rows_are_stored_as_many_as_spark_drops(spark, folder):
    path = f"{folder}/feed"
    base = closing(spark).drop("timestamp")
    for name, texts in (
        ("1", ["2024-01-01 10:00:00", "2024-01-01 12:00:00"]), ("2", ["2024-01-01 12:00:01"]), ("3", ["2024-01-01 12:00:02"]),
        ("4", ["2024-01-01 11:00:00", "2024-01-01 11:59:00", "2024-01-01 11:59:59"]), ("5", ["2024-01-02 00:00:00"]),
    ):
        rows = base.withColumn("timestamp", F.explode(F.array(*[F.lit(x).cast("timestamp") for x in texts]))).select(*COLUMNS)
        put(rows if name != "5" else rows.union(base.withColumn("timestamp", F.lit(None).cast("timestamp")).select(*COLUMNS)), path, name)
    out = f"{folder}/out"
    finish(closed.closed_batches(stream(spark, path), "timestamp", f"{folder}/store", lambda rows, n: sinks.write_batch(rows, out, n), f"{folder}/cp"))
    late = closed.late_rows(spark, f"{folder}/store", base.withColumn("timestamp", F.lit(None).cast("timestamp")).select(*COLUMNS))
    delays = sorted((r["late_us"] is None, r["late_us"]) for r in late.collect())
    assert delays == [(False, 57_000_000), (False, 3_597_000_000 - 0), (True, None)]
    with progress.ProgressLog(spark) as log:
        deduplicated = stream(spark, path).dropDuplicatesWithinWatermark(["timestamp"])
        log.wait(sinks.append_rows(deduplicated, f"{folder}/once", f"{folder}/cp2", "parquet"))
    assert log.table().agg(F.sum("dropped_rows")).first()[0] == 2


def test_distinct_counts_keep_one_value_a_state_row(spark, folder):
    many = spark.range(200_000).select(
        F.col("id").alias("event_id"), F.lit("2024-01-01 10:00:00").cast("timestamp").alias("timestamp"), F.pmod("id", F.lit(150_000)).alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(0.5).alias("amount"), F.lit("s").alias("session_id"), F.lit("a").alias("ip_address"), F.lit("l").alias("log_type"),
        F.lit(1).alias("response_size"),
    )
    put(many, f"{folder}/feed", "1")
    put(closing(spark), f"{folder}/feed", "2")
    query = finish(sinks.append_rows(windows.by_type(stream(spark, f"{folder}/feed")), f"{folder}/out", f"{folder}/cp", "parquet"))
    assert "collect_set" not in query._jsq.explainInternal(True)
    got = spark.read.parquet(f"{folder}/out").filter("event_type = 'view'").collect()
    assert [(r["event_count"], r["unique_users"], r["total_value"]) for r in got] == [(200_000, 150_000, 100_000.0)]


def test_score_stream_equals_table_at_any_moment(spark, folder):
    mixed_up(spark, f"{folder}/feed")
    moment = F.lit("2024-02-01").cast("timestamp")
    form = lambda df: analytics.behavior_score(df, moment, 86_400.0).select("window.start", "user_id", "category", "behavior_score", "last_activity")
    raw = stream(spark, f"{folder}/feed", "20 days").withColumn("category", F.col("log_type"))
    finish(sinks.append_rows(form(raw), f"{folder}/out", f"{folder}/cp", "parquet"))
    got = spark.read.parquet(f"{folder}/out").filter("user_id >= 0")
    assert collected(got) == collected(form(events(spark).withColumn("category", F.col("log_type"))))


def test_live_day_follows_the_latest_day(spark, folder):
    schema = SCHEMA + ", category STRING"
    path, out = f"{folder}/feed", f"{folder}/live"
    day = lambda d: events(spark).filter(F.to_date("timestamp") == d).withColumn("category", F.col("log_type"))

    def run():
        raw = windows.watermarked(source.file_stream(spark, f"{path}/*", schema, files_per_trigger=1), "timestamp", "1 day")
        finish(sinks.live_day(raw, "timestamp", f"{folder}/store", out, f"{folder}/cp"))
        return collected(spark.read.parquet(out).drop("day"))

    def table(df, d):
        return collected(analytics.live_metrics(df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), F.lit(d).cast("date")))

    even = F.col("event_id") % 2 == 0
    put(day("2024-01-03").filter(even), path, "1")
    assert run() == table(day("2024-01-03").filter(even), "2024-01-03")
    put(day("2024-01-03").filter(~even), path, "2")
    assert run() == table(day("2024-01-03"), "2024-01-03")
    put(day("2024-01-04"), path, "3")
    assert run() == table(day("2024-01-04"), "2024-01-04")


def test_batches_take_no_more_bytes_than_given(spark, folder):
    path = f"{folder}/feed"
    for n in range(6):
        put(events(spark).filter(F.pmod(F.col("event_id"), F.lit(6)) == n), path, str(n))
    sizes = [f.stat().st_size for f in __import__("pathlib").Path(path).glob("*/*.parquet")]
    limit = 2 * max(sizes)
    raw = source.file_stream(spark, f"{path}/*", SCHEMA, bytes_per_trigger=limit)
    query = finish(sinks.append_rows(raw, f"{folder}/out", f"{folder}/cp", "parquet"))
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert 3 <= len(batches) <= 6 and spark.read.parquet(f"{folder}/out").count() == events(spark).count()
    with pytest.raises(ValueError):
        source.file_stream(spark, path, SCHEMA, files_per_trigger=1, bytes_per_trigger=1)


def test_progress_of_all_streams_is_kept_and_flushed(spark, folder, feed):
    with progress.ProgressLog(spark) as log:
        for n in range(2):
            log.wait(sinks.append_rows(stream(spark, feed), f"{folder}/out{n}", f"{folder}/cp{n}", "parquet"))
    assert log.table().groupBy("run_id").agg(F.sum("input_rows").alias("n")).select("n").distinct().collect()[0][0] == events(spark).count() + 1
    log.flush(f"{folder}/metrics")
    assert log.table().count() == 0 and spark.read.parquet(f"{folder}/metrics").count() == 6


def test_data_set_is_read_again_only_when_files_change(spark, folder):
    path = f"{folder}/data"
    spark.range(5).write.parquet(path)
    first = datasets.in_memory(spark, "held_rows", path)
    assert first.count() == 5 and spark.catalog.isCached("held_rows")
    version = spark.conf.get(datasets.VERSION + "held_rows")
    assert datasets.in_memory(spark, "held_rows", path).count() == 5 and spark.conf.get(datasets.VERSION + "held_rows") == version
    spark.range(5, 8).write.mode("append").parquet(path)
    assert datasets.in_memory(spark, "held_rows", path).count() == 8 and spark.conf.get(datasets.VERSION + "held_rows") != version
    datasets.release(spark, "held_rows")
    assert not spark.catalog.tableExists("held_rows")


def test_late_rows_are_dropped_and_early_ones_kept(spark, folder):
    path = f"{folder}/feed"
    base = closing(spark).drop("timestamp")

    def at(text):
        return base.withColumn("timestamp", F.lit(text).cast("timestamp")).select(*COLUMNS)

    put(at("2024-01-01 10:00:00"), path, "1")
    put(at("2024-01-01 11:00:00"), path, "2")
    put(at("2024-01-01 11:00:02"), path, "2b")  # late rows are judged by the batch before last
    put(at("2024-01-01 10:01:00"), path, "3")  # older than the watermark by now
    put(at("2024-01-01 10:59:58"), path, "4")  # within the delay
    put(at("2024-01-02 00:00:00"), path, "5")
    put(at("2024-01-03 00:00:00"), path, "6")
    finish(sinks.append_rows(windows.by_type(stream(spark, path)), f"{folder}/out", f"{folder}/cp", "parquet"))
    got = spark.read.parquet(f"{folder}/out").select(F.date_format("window_start", "dd HH:mm"), "event_count")
    assert collected(got) == [("01 10:00", 1), ("01 10:55", 1), ("01 11:00", 2), ("02 00:00", 1)]


def test_repeated_events_are_dropped(spark, folder, feed):
    put(events(spark).orderBy(F.desc("timestamp")).limit(50), feed, "2b")
    once = sinks.without_duplicates(stream(spark, feed, "60 days"), "event_id")
    finish(sinks.append_rows(once, f"{folder}/out", f"{folder}/cp", "parquet"))
    got = spark.read.parquet(f"{folder}/out").filter("event_id >= 0")
    assert got.count() == got.select("event_id").distinct().count() == events(spark).count()


def test_restart_continues_without_loss(spark, folder):
    path, out, cp = f"{folder}/feed", f"{folder}/out", f"{folder}/cp"
    half = F.lit("2024-01-15").cast("timestamp")
    put(events(spark).filter(F.col("timestamp") < half), path, "1")
    first = finish(sinks.append_rows(windows.by_type(stream(spark, path)), out, cp, "parquet"))
    assert sum(p["numInputRows"] for p in first.recentProgress) > 0
    put(events(spark).filter(F.col("timestamp") >= half), path, "2")
    put(closing(spark), path, "3")
    finish(sinks.append_rows(windows.by_type(stream(spark, path)), out, cp, "parquet"))
    expected = windows.by_type(events(spark))
    got = spark.read.parquet(out).filter(F.col("window_start") < F.lit("2029-01-01").cast("timestamp"))
    assert collected(got.select(*expected.columns)) == collected(expected)


def test_delivery_to_day_folders(spark, folder, feed):
    query = sinks.deliver(stream(spark, feed), f"{folder}/lake", f"{folder}/cp", "timestamp", "day")
    finish(query)
    back = spark.read.schema(f"{SCHEMA}, year STRING, month STRING, day STRING").json(f"{folder}/lake")
    assert back.filter("event_id >= 0").count() == events(spark).count()
    assert back.filter("year = '2024' AND month = '01' AND day = '03'").select(
        F.date_format("timestamp", "yyyy-MM-dd")
    ).distinct().collect()[0][0] == "2024-01-03"
    progress = sinks.progress_table(query)
    assert progress.agg(F.sum("input_rows")).first()[0] == events(spark).count() + 1


def test_bad_records_go_to_their_own_place(spark, folder):
    raw = t.raw_records(spark, SMALL)
    raw.write.parquet(f"{folder}/feed")
    feed = source.file_stream(spark, f"{folder}/feed", raw.schema.simpleString()[7:-1].replace(":", " "))
    finish(sinks.split_records(feed, "received_at", f"{folder}/good", f"{folder}/bad", f"{folder}/cp"))
    good, bad = spark.read.parquet(f"{folder}/good"), spark.read.json(f"{folder}/bad")
    assert good.count() + bad.count() == raw.count()
    assert bad.count() == raw.filter(F.col("event_id") % 20 >= 16).count()
    assert {r[0] for r in bad.select("error").distinct().collect()} == {
        "missing:timestamp", "rule:timestamp_format", "missing:event_type", "type:user_id",
    }


def test_new_files_update_only_their_hours(spark, folder):
    path, lake, out, cp = (f"{folder}/{n}" for n in ("feed", "lake", "out", "cp"))

    def report(rows):
        return rows.groupBy("day", "hour").agg(F.count(F.lit(1)).alias("n"), F.max("batch").alias("batch"))

    def run():
        feed = source.file_stream(spark, f"{path}/*", SCHEMA, files_per_trigger=1)
        finish(sinks.rerun_touched_hours(feed, "timestamp", lake, SCHEMA, report, out, cp))

    day = F.to_date("timestamp")
    put(events(spark).filter(day == "2024-01-03"), path, "1")
    run()
    before = collected(spark.read.parquet(out))
    more = events(spark).filter((day == "2024-01-03") & (F.hour("timestamp") == 5))
    put(more, path, "2")
    run()
    after = spark.read.parquet(out)
    changed = set(collected(after)) - set(before)
    assert len(changed) == 1 and after.count() == len(before)
    assert after.filter("hour = 5").select("n").first()[0] == 2 * more.count()


def test_quality_metrics_of_a_stream(spark, folder):
    raw = t.raw_records(spark, SMALL)
    raw.coalesce(1).write.parquet(f"{folder}/feed/part=1")
    late = raw.limit(1).withColumn("received_at", F.lit("2030-01-01").cast("timestamp_ntz"))
    late.write.parquet(f"{folder}/feed/part=2")
    schema = "event_id BIGINT, received_at TIMESTAMP_NTZ, log_type STRING, record STRING"
    feed = source.file_stream(spark, f"{folder}/feed/*", schema, files_per_trigger=1)
    finish(sinks.append_rows(sinks.quality_stream(feed, "received_at"), f"{folder}/out", f"{folder}/cp", "parquet"))
    sums = spark.read.parquet(f"{folder}/out").agg(
        F.sum("total_records"), F.sum("valid_records"), F.sum("invalid_records")
    ).first()
    bad = raw.filter(F.col("event_id") % 20 >= 16).count()
    assert tuple(sums) == (raw.count(), raw.count() - bad, bad)


def test_lag_alarm_needs_two_periods(spark):
    lags = [10_000, 90_000, 70_000, 5_000, 61_000]
    rows = [(dt.datetime(2024, 1, 1, 0, i), lag) for i, lag in enumerate(lags)]
    progress = spark.createDataFrame([*rows, (dt.datetime(2024, 1, 1, 0, 9), None)], "at TIMESTAMP, lag_ms BIGINT")
    states = sinks.lag_alarms(progress).orderBy("period_start").select("state")
    assert [r[0] for r in states.collect()] == ["OK", "OK", "ALARM", "OK", "OK"]


def test_start_positions_have_known_names():
    assert source.START == {"LATEST": "latest", "TRIM_HORIZON": "earliest"}


def test_json_records_with_a_declared_schema(spark):
    df = spark.createDataFrame([('{"user_id": 1, "value": 2.5}',), ("broken",)], "record STRING")
    got = source.json_fields(df, "user_id BIGINT, value DOUBLE").collect()
    assert [tuple(r) for r in got] == [(1, 2.5), (None, None)]
