"""Projections, filters, profiling, sorts and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import text, times, values
from sluice.operators import project
from sluice.queries.registry import query
from sluice.sources import tables as t


@query("proj_select", "SELECT user_id, name FROM usr", "usr")
def proj_select(spark, folder):
    return t.users(spark, folder).select("user_id", "name")


@query("filter_cmp", "SELECT user_id, name, age FROM usr WHERE age >= 18", "usr")
def filter_cmp(spark, folder):
    return t.users(spark, folder).filter(F.col("age") >= 18).select("user_id", "name", "age")


@query(
    "filter_in",
    "SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'view', 'purchase')",
)
def filter_in(spark, folder):
    chosen = F.col("event_type").isin("click", "view", "purchase")
    return t.table(spark, folder, "events").filter(chosen).select("event_id", "user_id", "event_type")


@query("filter_notnull", "SELECT event_id, status_code FROM ev WHERE status_code IS NOT NULL", "ev")
def filter_notnull(spark, folder):
    return t.events(spark, folder).filter(F.col("status_code").isNotNull()).select("event_id", "status_code")


@query(
    "filter_between",
    """SELECT event_id, ts FROM events WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) = 15
       AND hour(ts) BETWEEN 10 AND 12""",
)
def filter_between(spark, folder):
    """The hour range as bounds on the raw column, so the scan can skip row groups."""
    first = F.lit("2024-01-15 10:00:00").cast("timestamp_ntz")
    last = F.lit("2024-01-15 12:59:59.999999").cast("timestamp_ntz")
    return t.table(spark, folder, "events").filter(F.col("ts").between(first, last)).select("event_id", "ts")


@query(
    "filter_day",
    "SELECT event_id, ts, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'",
)
def filter_day(spark, folder):
    start = F.lit("2024-01-10").cast("timestamp_ntz")
    end = F.lit("2024-01-11").cast("timestamp_ntz")
    return (
        t.table(spark, folder, "events")
        .filter((F.col("ts") >= start) & (F.col("ts") < end))
        .select("event_id", "ts", "value")
    )


@query(
    "filtered_breakdown",
    """WITH chosen AS (SELECT * FROM ev WHERE category IN ('books', 'food')
         AND event_type IN ('purchase', 'click') AND amount >= 20)
       SELECT 'category' AS dimension, category AS value, count(*) AS events,
         CAST(sum(m) AS DOUBLE) AS total_amount FROM chosen GROUP BY category
       UNION ALL
       SELECT 'event_type', event_type, count(*), CAST(sum(m) AS DOUBLE) FROM chosen GROUP BY event_type""",
    "ev",
)
def filtered_breakdown(spark, folder):
    by_category, by_type = project.filtered_breakdown(
        t.events(spark, folder), ["books", "food"], ["purchase", "click"], 20.0
    )
    return by_category.select(
        F.lit("category").alias("dimension"), F.col("category").alias("value"), "events", "total_amount"
    ).union(by_type.select(F.lit("event_type"), "event_type", "events", "total_amount"))


@query(
    "case_band",
    """SELECT user_id, age, CASE WHEN age < 18 THEN 'minor' WHEN age < 65 THEN 'adult' ELSE 'senior' END
       AS age_group FROM usr""",
    "usr",
)
def case_band(spark, folder):
    return t.users(spark, folder).select("user_id", "age", project.age_group("age").alias("age_group"))


@query(
    "dedup_key",
    """SELECT user_id, event_type, ts, event_id FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
       WHERE rn = 1""",
)
def dedup_key(spark, folder):
    return project.first_per_key(
        t.table(spark, folder, "events").select("user_id", "event_type", "ts", "event_id"),
        ["user_id", "event_type"],
        ["ts", "event_id"],
    )


@query("distinct_vals", "SELECT DISTINCT category, event_type FROM ev", "ev")
def distinct_vals(spark, folder):
    return t.events(spark, folder).select("category", "event_type").distinct()


@query("sample")
def sample(spark, folder):
    return t.table(spark, folder, "events").sample(fraction=0.1, seed=7).limit(1000)


@query(
    "describe",
    """SELECT 'amount' AS "column", count(amount) AS count, round(avg(amount), 6) AS mean,
         round(stddev_samp(amount), 6) AS stddev, min(amount) AS min, max(amount) AS max FROM ev
       UNION ALL
       SELECT 'status_code', count(status_code), round(avg(status_code), 6), round(stddev_samp(status_code), 6),
         CAST(min(status_code) AS DOUBLE), CAST(max(status_code) AS DOUBLE) FROM ev""",
    "ev",
)
def describe(spark, folder):
    out = project.describe(t.events(spark, folder), ["amount", "status_code"])
    return out.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


COLUMNS = (
    "event_id bigint, timestamp timestamp_ntz, user_id bigint, event_type string, amount double, category string, session_id string, "
    "ip_address string, method string, path string, log_type string, status_code int, response_size int, level string, logger string, "
    "message string, props string"
)


@query(
    "null_profile",
    """SELECT c AS "column", d AS data_type, n AS row_count, k AS null_count, k * 100.0::DOUBLE / n AS null_percent FROM ("""
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS c, '{d}' AS d, count(*) AS n, count(*) - count("{c}") AS k FROM ev"""
        for c, d in (x.split() for x in COLUMNS.split(", "))
    )
    + ")",
    "ev",
)
def null_profile(spark, folder):
    """Every column of the events."""
    return project.null_profile(t.events(spark, folder))


@query(
    "narrow_types",
    """SELECT event_id, CAST(user_id AS INTEGER) AS visitor, CAST(trunc(amount) AS INTEGER) AS units,
         CAST(amount AS DECIMAL(10,2)) AS amount FROM ev""",
    "ev",
)
def narrow_types(spark, folder):
    raw = t.events(spark, folder).select(
        "event_id", F.col("user_id").alias("visitor"), F.floor("amount").alias("units"), "amount"
    )
    return project.retype(project.narrow_longs(raw), {"amount": "decimal(10,2)"})


@query(
    "to_bool",
    """SELECT event_id, CASE k % 7 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN false
         WHEN 4 THEN false WHEN 5 THEN false END AS is_member FROM ev""",
    "ev",
)
def to_bool(spark, folder):
    words = F.array(*[F.lit(w) for w in ("yes", "True", "1", "no", "False", "0", "maybe")])
    k = F.get_json_object("props", "$.k").cast("int")
    raw = t.table(spark, folder, "events").select(
        "event_id", F.element_at(words, k % 7 + 1).alias("is_member")
    )
    return project.flags_to_boolean(raw)


@query(
    "reorder",
    'SELECT user_id, "timestamp", event_type, event_id, amount, category FROM ev',
    "ev",
)
def reorder(spark, folder):
    raw = t.events(spark, folder).select("event_id", "timestamp", "user_id", "event_type", "amount", "category")
    return project.hot_columns_first(raw, ["user_id", "timestamp", "event_type", "value"])


@query(
    "enrich",
    """SELECT user_id, name, email, age, signup_date,
         CASE WHEN age < 18 THEN 'minor' WHEN age < 65 THEN 'adult' ELSE 'senior' END AS age_group,
         split_part(email, '@', 2) AS email_domain,
         CAST(year(signup_date) AS INTEGER) AS signup_date_year,
         CAST(month(signup_date) AS INTEGER) AS signup_date_month,
         CAST(dayofweek(signup_date) + 1 AS INTEGER) AS signup_date_dayofweek,
         'segment' AS preferences_keys, segment AS preferences_values, 2 AS tags_size,
         round(ln(age + 1.0), 9) AS age_log, round(sqrt(age), 9) AS age_sqrt
       FROM usr""",
    "usr",
)
def enrich(spark, folder):
    out = project.enrich(t.users(spark, folder)).drop("preferences", "tags")
    return out.withColumns(
        {
            "preferences_keys": F.array_join("preferences_keys", ","),
            "preferences_values": F.array_join("preferences_values", ","),
            "age_log": F.round("age_log", 9),
            "age_sqrt": F.round("age_sqrt", 9),
        }
    )


@query(
    "by_hour_day",
    """SELECT 'hour' AS part, CAST(hour("timestamp") AS INTEGER) AS value, count(*) AS events,
         CAST(sum(m) AS DOUBLE) AS total_amount FROM ev GROUP BY 2
       UNION ALL
       SELECT 'day', CAST(day("timestamp") AS INTEGER), count(*), CAST(sum(m) AS DOUBLE) FROM ev GROUP BY 2""",
    "ev",
)
def by_hour_day(spark, folder):
    events = t.events(spark, folder)
    by_hour = project.by_time_part(events, F.hour("timestamp"), "value")
    by_day = project.by_time_part(events, F.dayofmonth("timestamp"), "value")
    return by_hour.select(F.lit("hour").alias("part"), "*").union(by_day.select(F.lit("day"), "*"))


# Sorts, limits and top lists.


@query("sort_desc", "SELECT event_id, ts FROM events ORDER BY ts DESC, event_id")
def sort_desc(spark, folder):
    return t.table(spark, folder, "events").select("event_id", "ts").orderBy(F.desc("ts"), "event_id")


@query("sort_multi", "SELECT user_id, event_type, ts, event_id FROM events ORDER BY user_id, event_type, ts")
def sort_multi(spark, folder):
    return (
        t.table(spark, folder, "events")
        .select("user_id", "event_type", "ts", "event_id")
        .orderBy("user_id", "event_type", "ts", "event_id")
    )


@query("sort_limit", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 10")
def sort_limit(spark, folder):
    raw = t.table(spark, folder, "events").select("event_id", "ts", "value")
    return raw.orderBy("ts", "event_id").limit(10)


def top_by(df, key: str, measure, name: str, n: int):
    """The n keys with the largest measure; each task keeps its own n before they are merged."""
    return df.groupBy(key).agg(measure.alias(name)).orderBy(F.desc(name), key).limit(n)


@query(
    "top_users",
    """SELECT user_id, CAST(sum(amount) AS DOUBLE) AS total_spent FROM ord GROUP BY user_id
       ORDER BY 2 DESC, 1 LIMIT 10""",
    "ord",
)
def top_users(spark, folder):
    return top_by(t.orders(spark, folder), "user_id", values.total("amount"), "total_spent", 10)


@query(
    "top_ips",
    "SELECT ip_address, count(*) AS request_count FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100",
    "ev",
)
def top_ips(spark, folder):
    return top_by(t.events(spark, folder), "ip_address", values.rows(), "request_count", 100)


@query(
    "top_categories",
    """(SELECT 'category' AS list, category AS item, CAST(sum(m) AS DOUBLE) AS measure FROM ev GROUP BY 2
         ORDER BY 3 DESC, 2 LIMIT 5)
       UNION ALL
       (SELECT 'hour', CAST(hour("timestamp") AS VARCHAR), CAST(count(*) AS DOUBLE) FROM ev GROUP BY 2
         ORDER BY 3 DESC, 2 LIMIT 5)""",
    "ev",
)
def top_categories(spark, folder):
    events = t.events(spark, folder)
    best = top_by(events, "category", values.total("amount"), "measure", 5)
    hours = events.select(F.hour("timestamp").cast("string").alias("hour"))
    busy = top_by(hours, "hour", values.rows().cast("double"), "measure", 5)
    return best.select(F.lit("category").alias("list"), F.col("category").alias("item"), "measure").union(
        busy.select(F.lit("hour"), "hour", "measure")
    )


# Scalar functions.


@query(
    "fn_string",
    """SELECT user_id, split_part(email, '@', 2) AS domain, name || '->' || email AS arrow,
         contains(email, 'gmail') AS has_gmail, email LIKE '%1%@%mail%' AS is_like FROM usr""",
    "usr",
)
def fn_string(spark, folder):
    email = F.col("email")
    return t.users(spark, folder).select(
        "user_id",
        text.email_domain("email").alias("domain"),
        F.concat("name", F.lit("->"), "email").alias("arrow"),
        email.contains("gmail").alias("has_gmail"),
        email.like("%1%@%mail%").alias("is_like"),
    )


@query(
    "fn_listagg",
    """SELECT user_id, string_agg(DISTINCT category, ' -> ' ORDER BY category) AS categories
       FROM ev GROUP BY user_id""",
    "ev",
)
def fn_listagg(spark, folder):
    seen = t.events(spark, folder).select("user_id", "category").distinct()
    return seen.groupBy("user_id").agg(
        F.expr("listagg(category, ' -> ') WITHIN GROUP (ORDER BY category)").alias("categories")
    )


@query(
    "fn_ip_mask",
    """SELECT event_id, CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN 'anonymized'
         ELSE '10.' || (user_id % 4) || '.' || (k % 16) || '.xxx' END AS ip FROM ev""",
    "ev",
)
def fn_ip_mask(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int") % 10
    given = F.when(k == 0, "").when(k == 1, "::1").otherwise(F.col("ip_address"))
    return t.events(spark, folder).select("event_id", text.mask_ip(given).alias("ip"))


@query(
    "fn_hash",
    """SELECT event_id, md5(session_id) AS session_hash, concat_ws('_', user_id, category) AS composite_key
       FROM ev""",
    "ev",
)
def fn_hash(spark, folder):
    return t.events(spark, folder).select(
        "event_id",
        F.md5("session_id").alias("session_hash"),
        F.concat_ws("_", "user_id", "category").alias("composite_key"),
    )


@query(
    "fn_date",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(dayofweek(ts) + 1 AS INTEGER) AS dayofweek, CAST(ts AS DATE) AS date,
         strftime(ts, '%Y-%m-%d') AS day_text, strftime(ts, '%Y-%m-%d %H:00:00') AS hour_text,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) - 1704067200 AS seconds_since,
         CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS days_since
       FROM events""",
)
def fn_date(spark, folder):
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return t.table(spark, folder, "events").select(
        "event_id",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        F.dayofmonth("ts").alias("day"),
        F.hour("ts").alias("hour"),
        F.dayofweek("ts").alias("dayofweek"),
        times.day("ts").alias("date"),
        F.date_format("ts", "yyyy-MM-dd").alias("day_text"),
        times.hour_label("ts").alias("hour_text"),
        times.seconds_between(F.col("ts"), start).alias("seconds_since"),
        F.datediff("ts", start).alias("days_since"),
    )


@query(
    "fn_parse_ts",
    """SELECT event_id, ts AS iso_time, date_trunc('second', received_at) AS access_time FROM rec""",
    "rec",
)
def fn_parse_ts(spark, folder):
    raw = t.raw_records(spark, folder)
    access_text = F.concat(F.date_format("received_at", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000"))
    return raw.select(
        "event_id",
        times.parse_iso(F.get_json_object("record", "$.timestamp")).cast("timestamp_ntz").alias("iso_time"),
        times.parse_access_time(access_text).cast("timestamp_ntz").alias("access_time"),
    )


@query(
    "fn_math",
    """SELECT event_id, round(ln(amount + 1), 9) AS log_amount, round(sqrt(abs(amount)), 9) AS root_amount,
         round(exp(-k / 100.0::DOUBLE), 9) AS decay,
         CASE WHEN k % 5 = 0 THEN NULL ELSE amount / (k % 5) END AS guarded
       FROM ev""",
    "ev",
)
def fn_math(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events(spark, folder).select(
        "event_id",
        F.round(F.log1p("amount"), 9).alias("log_amount"),
        F.round(F.sqrt(F.abs("amount")), 9).alias("root_amount"),
        F.round(F.exp(-k / F.lit(100.0)), 9).alias("decay"),
        values.ratio("amount", k % 5).alias("guarded"),
    )


@query(
    "fn_null",
    """SELECT event_id, coalesce(status_code, 0) AS status_code, coalesce(event_type, 'unknown') AS event_type
       FROM ev""",
    "ev",
)
def fn_null(spark, folder):
    return t.events(spark, folder).select(
        "event_id",
        F.coalesce("status_code", F.lit(0)).alias("status_code"),
        F.coalesce("event_type", F.lit("unknown")).alias("event_type"),
    )


@query("fn_map", "SELECT user_id, 'segment' AS keys, segment AS vals FROM usr", "usr")
def fn_map(spark, folder):
    return t.users(spark, folder).select(
        "user_id",
        F.array_join(F.map_keys("preferences"), ",").alias("keys"),
        F.array_join(F.map_values("preferences"), ",").alias("vals"),
    )


@query(
    "fn_array",
    """SELECT user_id, 2 AS n_tags, segment || ',n' || c_nationkey AS tag_set, segment AS first_tag FROM usr""",
    "usr",
)
def fn_array(spark, folder):
    doubled = F.array_distinct(F.concat("tags", "tags"))
    return t.users(spark, folder).select(
        "user_id",
        F.size("tags").alias("n_tags"),
        F.array_join(doubled, ",").alias("tag_set"),
        F.element_at("tags", 1).alias("first_tag"),
    )


@query(
    "fn_json",
    """SELECT event_id, coalesce(event_type, 'unknown') AS event_type, value,
         '{"event_type":"' || coalesce(event_type, 'unknown') || '","value":' || CAST(value AS VARCHAR) || '}'
           AS written
       FROM rec""",
    "rec",
)
def fn_json(spark, folder):
    payload = F.base64(F.encode("record", "UTF-8"))
    body = F.decode(F.unbase64(payload), "UTF-8")
    got = F.from_json(body, "event_type STRING, value DOUBLE")
    return (
        t.raw_records(spark, folder)
        .select("event_id", got.alias("got"))
        .select(
            "event_id",
            F.coalesce("got.event_type", F.lit("unknown")).alias("event_type"),
            F.col("got.value").alias("value"),
        )
        .withColumn("written", F.to_json(F.struct("event_type", "value")))
    )


@query(
    "fn_cast",
    """SELECT event_id, CAST(trunc(value) AS INTEGER) AS as_int, CAST(value AS FLOAT)::DOUBLE AS as_float,
         CAST(value AS DECIMAL(10,2)) AS as_decimal, value > 0 AS as_boolean,
         CASE WHEN event_id % 20 = 19 THEN NULL ELSE user_id END AS user_number
       FROM events""",
)
def fn_cast(spark, folder):
    user_text = F.when(F.col("event_id") % 20 == 19, "invalid_user_id").otherwise(
        F.col("user_id").cast("string")
    )
    return t.table(spark, folder, "events").select(
        "event_id",
        F.col("value").cast("int").alias("as_int"),
        F.col("value").cast("float").cast("double").alias("as_float"),
        F.col("value").cast("decimal(10,2)").alias("as_decimal"),
        F.col("value").cast("boolean").alias("as_boolean"),
        user_text.try_cast("bigint").alias("user_number"),
    )
