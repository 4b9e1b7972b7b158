"""Round trips, partition folders, codecs and repeated runs."""

from __future__ import annotations

import os

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from sluice.operators import layout
from sluice.session import scratch_path, settled, tuned_session
from sluice.sources import readers, writers
from sluice.sources import tables as t

LAKE = "event_id BIGINT, timestamp TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, amount DOUBLE, category STRING"


def events(spark):
    return t.events(spark, SMALL).select("event_id", "timestamp", "user_id", "event_type", "amount", "category")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize(("granularity", "depth"), [("hour", 4), ("day", 3)])
def test_time_folders(spark, folder, granularity, depth):
    few = events(spark).filter("timestamp < '2024-01-03'")
    writers.write_partitioned(few, folder + "/lake", "timestamp", granularity)
    lake = readers.read_partitioned(spark, folder + "/lake", LAKE, granularity=granularity)
    assert same(lake.select(*few.columns), few)
    assert {r[0] for r in lake.select("month").distinct().collect()} == {"01"}
    path = next(p for p, _, files in os.walk(folder + "/lake") if any(f.endswith(".json") for f in files))
    assert path.count("=") == depth


def test_folder_filters_reach_the_scan(spark, folder):
    few = events(spark).filter("timestamp < '2024-01-03'")
    writers.write_partitioned(few, folder, "timestamp", "hour")
    lake = readers.read_partitioned(spark, folder, LAKE).filter("day = '01' AND hour BETWEEN '10' AND '12'")
    plan = lake._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert lake.count() == few.filter("day(timestamp) = 1 AND hour(timestamp) BETWEEN 10 AND 12").count()


def test_path_columns(spark, folder):
    few = events(spark).filter("timestamp < '2024-01-02'")
    writers.write_partitioned(few, folder, "timestamp", "day", fmt="parquet")
    raw = spark.read.schema(LAKE).option("recursiveFileLookup", True).parquet(folder)
    got = readers.with_path_columns(raw, "day").select("year", "month", "day").distinct().collect()
    assert [tuple(r) for r in got] == [(2024, 1, 1)]


def test_region_folders(spark, folder):
    writers.write_by_region(events(spark), folder, "timestamp", "category")
    back = spark.read.parquet(folder)
    assert back.count() == events(spark).count() and {"year", "month", "category"} <= set(back.columns)


def test_parquet_files_and_folders(spark, folder):
    writers.write_parquet(events(spark), folder + "/one", files=1)
    assert sum(f.endswith(".parquet") for f in os.listdir(folder + "/one")) == 1
    writers.write_parquet(events(spark), folder + "/by", files=1, partition_by=("category",))
    assert same(spark.read.parquet(folder + "/by").select(*events(spark).columns), events(spark))


def test_rerun_of_one_hour_replaces_that_hour(spark, folder):
    table = events(spark).withColumn("hour", F.date_format("timestamp", "HH"))
    writers.replace_partitions(table, folder, ["hour"])
    once = spark.read.parquet(folder).count()
    writers.replace_partitions(table.filter("hour = '05'"), folder, ["hour"])
    assert spark.read.parquet(folder).count() == once
    writers.replace_partitions(table.filter("hour = '05'").limit(1), folder, ["hour"])
    assert spark.read.parquet(folder).filter("hour = 5").count() == 1


@pytest.mark.parametrize(("use", "fmt", "mark"), [("realtime", "parquet", "snappy"), ("batch", "parquet", "gz"), ("archive", "json", "bz2")])
def test_codec_by_use(spark, folder, use, fmt, mark):
    writers.write_for(events(spark), folder + "/out", use, fmt)
    assert any(mark in f for f in os.listdir(folder + "/out"))
    with pytest.raises(ValueError):
        writers.write_for(events(spark), folder + "/no", "archive", "parquet")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_load_with_named_schema(spark, folder, fmt):
    path = f"{folder}/{fmt}"
    orders = t.orders(spark, SMALL).select(
        "order_id", "user_id", F.lit(1).cast("bigint").alias("product_id"),
        F.col("amount").cast("decimal(10,2)").alias("amount"), "order_date", "status",
    )
    orders.write.options(header=True).format(fmt).save(path)
    assert same(readers.load(spark, path, "order", fmt, multiline=False), orders)


def test_unknown_schema_and_format(spark):
    with pytest.raises(ValueError, match="no schema named"):
        readers.load(spark, "/nowhere", "invoice")
    with pytest.raises(ValueError, match="unsupported format"):
        readers.load(spark, "/nowhere", "order", "xml")


def test_run_metadata_counts_what_was_written(spark, folder):
    row = writers.write_with_metadata(events(spark), folder + "/out", F.current_timestamp()).first()
    assert row["total_records"] == events(spark).count() and row["output_path"].endswith("/out")


def test_split_output(spark, folder):
    df = events(spark)
    writers.write_split(df.filter("amount >= 10"), df.filter("amount < 10"), folder + "/good", folder + "/bad")
    assert spark.read.parquet(folder + "/good").count() + spark.read.json(folder + "/bad").count() == df.count()


def test_cache_is_released(spark):
    df = events(spark)
    with layout.cached(df, "memory_disk") as held:
        assert held.is_cached and held.count() > 0
    assert not df.is_cached
    with pytest.raises(RuntimeError), layout.cached(df, "memory"):
        raise RuntimeError
    assert not df.is_cached


def test_cached_table_can_be_refreshed(spark, folder):
    events(spark).limit(10).write.parquet(folder + "/t")
    spark.sql(f"CREATE TABLE cached_events USING parquet LOCATION '{folder}/t'")
    spark.sql("CACHE TABLE cached_events")
    assert spark.table("cached_events").count() == 10
    events(spark).limit(5).write.mode("append").parquet(folder + "/t")
    spark.sql("REFRESH TABLE cached_events")
    assert spark.table("cached_events").count() == 15
    spark.sql("UNCACHE TABLE cached_events")


def test_fitting_partitions(spark):
    df = spark.range(0, 1000, 1, 7)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    # The optimizer knows the rows of a range; the number is a wish that adaptive execution adjusts.
    assert "RoundRobinPartitioning(3), REBALANCE" in plan(layout.fit_to_rows(df, per_partition=300))
    assert "RoundRobinPartitioning(20), REBALANCE" in plan(layout.fit_to_rows(df, per_partition=50))
    assert "Coalesce 1" in plan(layout.fit_to_size(df))
    assert layout.fit_to_rows(df, per_partition=300).count() == 1000
    texts = df.select(F.col("id").cast("string").alias("a")).filter("a <> 'x'")
    assert layout.estimated_rows(texts) > 0


def test_fitting_starts_no_job(spark):
    tracker, group = spark.sparkContext.statusTracker(), "fitting"
    spark.sparkContext.setJobGroup(group, group)
    df = events(spark).groupBy("user_id").count()
    layout.fit_to_rows(df)
    layout.fit_to_size(df)
    assert not list(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_broadcast_depends_on_size(spark):
    small, big = spark.range(10), spark.range(10**9)
    assert layout.broadcast_when_small(big) is big
    assert layout.broadcast_when_small(small) is not small


def test_working_folder_is_the_one_of_the_session(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert settled(spark.range(5)).count() == 5


def test_session_profile(spark):
    again = tuned_session("again")
    assert again.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert again.conf.get("spark.sql.session.timeZone") == "UTC"
