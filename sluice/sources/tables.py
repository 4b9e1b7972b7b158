"""The given tables, and the record shapes the jobs expect, derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.times import day, month_label
from sluice.functions.values import cents, mean
from sluice.schemas import TABLES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A parquet table with its declared schema, so no file footer is read for planning."""
    reader = spark.read.option("mergeSchema", "false")
    if name in TABLES:
        reader = reader.schema(TABLES[name])
    return reader.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Lake events with the web and application log fields, one row per event."""
    k = F.get_json_object("props", "$.k").cast("int")
    raw = table(spark, folder, "events").withColumn("k", k)
    kind, k = F.col("event_type"), F.col("k")
    category = (
        F.when(k % 4 == 0, "books").when(k % 4 == 1, "clothing").when(k % 4 == 2, "electronics")
    ).otherwise("food")
    log_type = (
        F.when(kind == "error", "application").when(k % 2 == 0, "apache_access")
    ).otherwise("nginx_access")
    status = (
        F.when(kind == "error", F.lit(None).cast("int"))
        .when((kind == "purchase") & (k % 20 == 7), 500)
        .when((kind == "click") & (k % 10 == 0), 404)
        .when((kind == "view") & (k % 25 == 0), 301)
        .when(kind == "signup", 201)
        .otherwise(200)
    )
    level = F.when(k % 4 == 0, "DEBUG").when(k % 4 == 1, "INFO").when(k % 4 == 2, "WARN").otherwise("ERROR")
    user = F.col("user_id").cast("string")
    return raw.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        "user_id",
        "event_type",
        F.col("value").alias("amount"),
        category.alias("category"),
        F.concat(F.lit("s"), user, F.lit("_"), day("ts").cast("string")).alias("session_id"),
        F.concat(
            F.lit("10."), (F.col("user_id") % 4).cast("string"), F.lit("."), (k % 16).cast("string"),
            F.lit("."), user,
        ).alias("ip_address"),
        F.when(kind.isin("purchase", "signup"), "POST").otherwise("GET").alias("method"),
        F.concat(F.lit("/"), kind).alias("path"),
        log_type.alias("log_type"),
        status.alias("status_code"),
        F.round(F.col("value") * 100).cast("int").alias("response_size"),
        level.alias("level"),
        F.concat(F.lit("com.example."), category).alias("logger"),
        F.concat(kind, F.lit(" "), (k % 5).cast("string")).alias("message"),
        "props",
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    domain = F.when(key % 3 == 0, "gmail.com").when(key % 3 == 1, "yahoo.com").otherwise("hotmail.com")
    return table(spark, folder, "customer").select(
        key.alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("u"), key.cast("string"), F.lit("@"), domain).alias("email"),
        (F.lit(15) + key % 60).cast("int").alias("age"),
        F.date_add(F.lit("1994-01-01").cast("date"), (key % 1500).cast("int")).alias("signup_date"),
        F.create_map(F.lit("segment"), F.col("c_mktsegment")).alias("preferences"),
        F.array("c_mktsegment", F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("tags"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        cents("o_totalprice").alias("amount"),
        day("o_orderdate").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
    )


def order_details(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly sales per market segment and region; its size follows the calendar, not the orders."""
    per_customer_month = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", month_label("o_orderdate").alias("month"))
        .agg(F.sum(cents("o_totalprice")).alias("amount"))
    )
    region = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    where = (
        table(spark, folder, "customer")
        .join(region, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("c_mktsegment").alias("salesperson"), F.col("r_name").alias("region"))
    )
    return (
        per_customer_month.join(where, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("salesperson", "region", "month")
        .agg(F.sum("amount").cast("double").alias("sales"))
    )


def stock(spark: SparkSession, folder: str) -> DataFrame:
    """A daily price series per event type."""
    return (
        table(spark, folder, "events")
        .groupBy(F.col("event_type").alias("symbol"), day("ts").alias("date"))
        .agg(mean("value").alias("price"))
    )


def change_events(spark: SparkSession, folder: str) -> DataFrame:
    """Change records of the orders table: insert, later update and delete of the same key."""
    image = F.struct(F.col("o_orderstatus").alias("status"), cents("o_totalprice").alias("amount"))
    none = F.lit(None).cast("struct<status:string,amount:decimal(18,2)>")
    updated = F.struct(F.lit("X").alias("status"), cents("o_totalprice").alias("amount"))
    change = F.when(F.col("o_orderstatus") == "F", updated).otherwise(image)
    steps = F.array_compact(
        F.array(
            F.struct(F.lit(0).alias("step"), F.lit("INSERT").alias("operation"), none.alias("before"),
                     image.alias("after")),
            F.when(
                F.col("o_orderstatus").isin("F", "P"),
                F.struct(F.lit(1).alias("step"), F.lit("UPDATE").alias("operation"),
                         image.alias("before"), change.alias("after")),
            ),
            F.when(
                F.col("o_orderkey") % 50 == 0,
                F.struct(F.lit(2).alias("step"), F.lit("DELETE").alias("operation"),
                         change.alias("before"), none.alias("after")),
            ),
        )
    )
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_orderdate", F.inline(steps))
        .select(
            (F.col("o_orderdate") + F.make_dt_interval(days=F.col("step"))).alias("timestamp"),
            F.lit("shop").alias("database"),
            F.lit("orders").alias("table"),
            "operation",
            (F.col("o_orderkey") * 3 + F.col("step")).alias("transaction_id"),
            F.col("o_orderkey").alias("key"),
            "before",
            "after",
        )
    )


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """JSON text records in which one in five carries one of four defects."""
    turn = F.col("event_id") % 20
    stamp = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    body = F.to_json(
        F.struct(
            "event_id",
            F.when(turn == 17, "invalid-time-format").when(turn != 16, stamp).alias("timestamp"),
            F.when(turn != 18, F.col("event_type")).alias("event_type"),
            "session_id",
            "ip_address",
            F.col("amount").alias("value"),
        )
    )
    user = F.when(turn == 19, F.lit('"invalid_user_id"')).otherwise(F.col("user_id").cast("string"))
    record = F.concat(F.expr("left(_body, length(_body) - 1)"), F.lit(',"user_id":'), user, F.lit("}"))
    return (
        events(spark, folder)
        .withColumn("_body", body)
        .select("event_id", F.col("timestamp").alias("received_at"), "log_type", record.alias("record"))
    )


def raw_web_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Access log lines written out from the web events."""
    web = events(spark, folder).filter(F.col("log_type") != "application")
    dash = F.lit("-")
    line = F.concat(
        F.col("ip_address"), F.lit(" - - ["),
        F.date_format("timestamp", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000] \""),
        F.col("method"), F.lit(" "), F.col("path"), F.lit(" HTTP/1.1\" "),
        F.col("status_code").cast("string"), F.lit(" "),
        F.when(F.col("status_code") == 301, dash).otherwise(F.col("response_size").cast("string")),
        F.lit(" \""), F.when(F.col("event_type") == "click", F.lit("/home")).otherwise(dash),
        F.lit("\" \"curl/7.68.0\""),
    )
    return web.select("event_id", "log_type", line.alias("line"))


def raw_app_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Application log lines: JSON, and now and then plain text."""
    app = events(spark, folder).filter(F.col("log_type") == "application")
    body = F.to_json(
        F.struct(
            F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
            F.when(F.col("level") != "INFO", F.col("level")).alias("level"),
            "message",
            F.when(F.col("level") != "DEBUG", F.col("logger")).alias("logger"),
            F.col("user_id").cast("string").alias("user_id"),
        )
    )
    line = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("plain text "), "message")).otherwise(body)
    return app.select("event_id", line.alias("line"))




def versioned_records(spark: SparkSession, folder: str) -> DataFrame:
    """Event records of three schema versions, in the columns of the newest."""
    turn = F.col("event_id") % 3
    text = F.get_json_object("props", "$.k")
    return events(spark, folder).select(
        "event_id",
        F.when(turn == 0, "v1.0").when(turn == 1, "v1.1").otherwise("v1.2").alias("version"),
        "timestamp",
        "event_type",
        "user_id",
        F.col("amount").cast("string").alias("value"),
        F.when(turn > 0, F.col("session_id")).alias("session_id"),
        F.when(turn > 1, F.create_map(F.lit("k"), text)).alias("properties"),
    )
