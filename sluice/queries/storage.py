"""Scans, layouts and sinks. Each query writes the given tables out and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.times import partition_key
from sluice.functions.values import mean, rows, total
from sluice.operators.geo import locate
from sluice.plans import analytics
from sluice.queries.registry import query
from sluice.schemas import TABLES
from sluice.session import scratch_path
from sluice.sources import readers, writers
from sluice.sources import tables as t

RAW = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


@query(
    "scan_schema",
    """SELECT event_id, user_id, event_type, ts AS "timestamp", value, 'props' AS keys, props AS "values" FROM events""",
)
def scan_schema(spark, folder):
    path = scratch_path(spark, "scan-schema")
    t.table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("timestamp"), "value",
        F.create_map(F.lit("props"), "props").alias("properties"),
    ).write.parquet(path)
    out = readers.load(spark, path, "event")
    return out.select(
        "event_id", "user_id", "event_type", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "value",
        F.array_join(F.map_keys("properties"), ",").alias("keys"),
        F.array_join(F.map_values("properties"), ",").alias("values"),
    )


@query("scan_parquet", RAW)
def scan_parquet(spark, folder):
    return readers.read_parquet(spark, f"{folder}/events.parquet")


@query("scan_jsonl", RAW)
def scan_jsonl(spark, folder):
    root = scratch_path(spark, "scan-jsonl")
    t.table(spark, folder, "events").write.options(**readers.MICROS).json(root)
    return readers.read_json_lines(spark, f"{root}/*.json", TABLES["events"])


@query("scan_csv", RAW)
def scan_csv(spark, folder):
    root = scratch_path(spark, "scan-csv")
    t.table(spark, folder, "events").write.options(**readers.CSV).csv(root)
    return readers.read_csv(spark, root, TABLES["events"])


@query("scan_orc", RAW)
def scan_orc(spark, folder):
    root = scratch_path(spark, "scan-orc")
    t.table(spark, folder, "events").write.option("compression", "snappy").orc(root)
    return readers.read_orc(spark, root)


def lake_events(spark, folder):
    return t.events(spark, folder).select(
        F.col("event_id").alias("id"), "timestamp", "user_id", "event_type", "amount", "category"
    )


LAKE = "id BIGINT, timestamp TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, amount DOUBLE, category STRING"


def partitioned_lake(spark, folder):
    root = scratch_path(spark, "lake")
    writers.write_partitioned(lake_events(spark, folder), root, "timestamp", "hour", "json")
    return root


@query(
    "path_partitions",
    """SELECT event_id AS id, amount, CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
         CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour FROM ev""",
    "ev",
)
def path_partitions(spark, folder):
    """The tree is read by a glob, so the folders are no partition columns."""
    root = partitioned_lake(spark, folder)
    raw = readers.read_json_lines(spark, f"{root}/*/*/*/*/*.json", LAKE)
    return readers.with_path_columns(raw).select("id", "amount", "year", "month", "day", "hour")


@query(
    "pruned_scan",
    """SELECT event_id AS id, "timestamp", amount, strftime("timestamp", '%H') AS hour FROM ev
       WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15' AND hour("timestamp") BETWEEN 10 AND 12""",
    "ev",
)
def pruned_scan(spark, folder):
    lake = readers.read_partitioned(spark, partitioned_lake(spark, folder), LAKE)
    chosen = lake.filter("year = '2024' AND month = '01' AND day = '15' AND hour BETWEEN '10' AND '12'")
    return chosen.select("id", "timestamp", "amount", "hour")


@query("codec_sizes")
def codec_sizes(spark, folder):
    return writers.codec_sizes(t.table(spark, folder, "events"), scratch_path(spark, "codecs"))


@query(
    "json_to_parquet",
    """SELECT event_id, ts AS event_time, event_type, user_id, value, false AS rejected FROM rec WHERE turn <> 19
       UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, true FROM rec WHERE turn = 19""",
    "rec",
)
def json_to_parquet(spark, folder):
    """Records whose fields do not fit the declared types go to the error place, whole."""
    raw, columnar, errors = (scratch_path(spark, n) for n in ("raw", "columnar", "errors"))
    t.raw_records(spark, folder).select("record").write.text(raw)
    declared = "event_id BIGINT, timestamp STRING, event_type STRING, user_id BIGINT, value DOUBLE"
    writers.json_to_parquet(spark, raw, declared, columnar, errors)
    good = readers.read_parquet(spark, columnar).select(
        "event_id", F.try_to_timestamp("timestamp").cast("timestamp_ntz").alias("event_time"),
        "event_type", "user_id", "value", F.lit(False).alias("rejected"),
    )
    bad = spark.read.text(errors).select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), F.lit(True).alias("rejected"))
    return good.unionByName(bad, allowMissingColumns=True)


@query("format_report")
def format_report(spark, folder):
    return writers.format_report(lake_events(spark, folder), scratch_path(spark, "formats"))


FOUR = """SELECT '{f}' AS format, 'count' AS item, CAST(count(*) AS DOUBLE) AS value FROM ev
  UNION ALL SELECT '{f}', 'books', CAST(count(*) AS DOUBLE) FROM ev WHERE category = 'books'
  UNION ALL SELECT '{f}', 'mean', CAST(sum(m) AS DOUBLE) / count(m) FROM ev
  UNION ALL SELECT '{f}', category, CAST(sum(m) AS DOUBLE) FROM ev GROUP BY category"""


@query(
    "format_queries",
    " UNION ALL ".join(FOUR.format(f=f) for f in ("csv", "parquet_snappy")),
    "ev",
)
def format_queries(spark, folder):
    """Row count, filter, mean and sum by category over two layouts of the same table."""
    source = lake_events(spark, folder)
    wanted = ("csv", "parquet_snappy")
    written = writers.write_formats(source, scratch_path(spark, "formats"), wanted)
    out = None
    for name in wanted:
        df = writers.read_format(spark, name, written[name][0], source.schema)
        whole = df.agg(
            rows().cast("double").alias("count"),
            F.count_if(F.col("category") == "books").cast("double").alias("books"),
            mean("amount").alias("mean"),
        )
        lines = whole.select(
            F.inline(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("value")) for c in whole.columns]))
        ).union(df.groupBy("category").agg(total("amount")))
        lines = lines.select(F.lit(name).alias("format"), "item", "value")
        out = lines if out is None else out.union(lines)
    return out


@query(
    "partition_key",
    """SELECT event_id, coalesce(strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H'),
         'year=unknown/month=unknown/day=unknown/hour=unknown') AS partition_key FROM rec""",
    "rec",
)
def partition_key_of_records(spark, folder):
    stamp = F.get_json_object("record", "$.timestamp")
    return t.raw_records(spark, folder).select("event_id", partition_key(stamp).alias("partition_key"))


def address_ranges(spark, folder):
    """Half of the block 10.n.0.0/20 belongs to nation n."""
    first = (F.lit(10) * 2**24 + F.col("n_nationkey") * 2**16).cast("bigint")
    nation = t.table(spark, folder, "nation").join(
        t.table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nation.select(
        first.alias("first_ip"), (first + 2047).alias("last_ip"),
        F.col("n_name").alias("country"), F.col("r_name").alias("region"),
    )


@query(
    "geo_partition",
    """SELECT event_id, CASE WHEN k % 16 < 8 AND user_id < 256 THEN n_name ELSE 'unknown' END AS country,
         CASE WHEN k % 16 < 8 AND user_id < 256 THEN r_name ELSE 'unknown' END AS region
       FROM ev JOIN nation ON n_nationkey = user_id % 4 JOIN region ON n_regionkey = r_regionkey""",
    "ev",
)
def geo_partition(spark, folder):
    raw = t.events(spark, folder).select("event_id", "ip_address")
    return locate(raw, "ip_address", address_ranges(spark, folder)).drop("ip_address")


FIXED_TIME = "TIMESTAMP '2024-02-01'"


def fixed_time():
    return F.lit("2024-02-01").cast("timestamp_ntz")


@query(
    "run_metadata",
    f"SELECT count(*) AS total_records, {FIXED_TIME} AS processing_timestamp FROM events",
)
def run_metadata(spark, folder):
    """The place of the output is left out here, as it is new on every run."""
    path = scratch_path(spark, "run")
    return writers.write_with_metadata(t.events(spark, folder), path, fixed_time()).drop("output_path")


@query(
    "sql_preview",
    """SELECT CAST(ts AS DATE) AS date, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS daily_sales FROM events
       WHERE event_type = 'purchase' GROUP BY 1 ORDER BY 1 LIMIT 10""",
)
def sql_preview(spark, folder):
    """Files registered as a table of the catalog and read by SQL."""
    path = scratch_path(spark, "daily")
    analytics.daily_sales(t.events(spark, folder)).write.parquet(path)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    return spark.sql(f"SELECT * FROM {name} ORDER BY date LIMIT 10")


@query(
    "multi_source",
    """SELECT user_id, name, total_events, orders FROM usr
       JOIN (SELECT user_id, count(*) AS total_events FROM events GROUP BY 1) USING (user_id)
       LEFT JOIN (SELECT user_id, count(*) AS orders FROM ord GROUP BY 1) USING (user_id)""",
    "usr ord",
)
def multi_source(spark, folder):
    """A CSV file, the result of an earlier job, and raw JSON lines in one view."""
    root = scratch_path(spark, "sources")
    t.users(spark, folder).select("user_id", "name").write.option("header", True).csv(f"{root}/users")
    analytics.user_summary(t.events(spark, folder)).write.parquet(f"{root}/summary")
    t.orders(spark, folder).select("order_id", "user_id").write.json(f"{root}/orders")

    people = readers.read_csv(spark, f"{root}/users", "user_id BIGINT, name STRING")
    summary = readers.read_parquet(spark, f"{root}/summary").select("user_id", "total_events")
    orders = readers.read_json_lines(spark, f"{root}/orders", "order_id BIGINT, user_id BIGINT")
    per_user = orders.groupBy("user_id").agg(rows().alias("orders"))
    return people.join(summary, "user_id").join(per_user, "user_id", "left")


@query(
    "index_docs",
    f"""SELECT event_type || '_' || CAST(floor(epoch("timestamp")) AS BIGINT) AS _id, event_type, amount,
          'stream_analytics' AS processed_by, {FIXED_TIME} AS processed_at FROM ev""",
    "ev",
)
def index_docs(spark, folder):
    raw = t.events(spark, folder).select("event_type", "timestamp", "amount")
    docs = writers.index_documents(raw, "timestamp", fixed_time(), "stream_analytics")
    got = F.from_json("document", "event_type STRING, amount DOUBLE, processed_by STRING, `@timestamp` TIMESTAMP_NTZ")
    return docs.select("_id", got.alias("d")).select(
        "_id", "d.event_type", "d.amount", "d.processed_by", F.col("d.`@timestamp`").alias("processed_at")
    )
