"""Joins and aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.values import rows, total
from sluice.operators import aggregates, joins, layout
from sluice.plans import log_reports
from sluice.queries.registry import query
from sluice.sources import tables as t

PAIR = "user_id, name, order_id, CAST(amount AS DOUBLE) AS amount"


def paired(df):
    return df.select("user_id", "name", "order_id", F.col("amount").cast("double").alias("amount"))


@query("join_inner", f"SELECT {PAIR} FROM usr JOIN ord USING (user_id)", "usr ord")
def join_inner(spark, folder):
    return paired(t.users(spark, folder).join(t.orders(spark, folder), "user_id"))


@query(
    "join_left",
    """SELECT order_id, CAST(amount AS DOUBLE) AS amount, line, product_id
       FROM ord LEFT JOIN det USING (order_id)""",
    "ord det",
)
def join_left(spark, folder):
    joined = joins.keep_all(t.orders(spark, folder), t.order_details(spark, folder), "order_id")
    return joined.select("order_id", F.col("amount").cast("double").alias("amount"), "line", "product_id")


@query(
    "join_right",
    "SELECT user_id, event_id, event_type, name FROM (SELECT * FROM events) e RIGHT JOIN usr USING (user_id)",
    "usr",
)
def join_right(spark, folder):
    events = t.table(spark, folder, "events").select("user_id", "event_id", "event_type")
    return joins.keep_all(t.users(spark, folder).select("user_id", "name"), events, "user_id")


@query(
    "join_full",
    """SELECT day, ordered, shipped FROM
         (SELECT order_date AS day, count(*) AS ordered FROM ord GROUP BY 1)
       FULL JOIN
         (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS shipped FROM lineitem GROUP BY 1) USING (day)""",
    "ord",
)
def join_full(spark, folder):
    """Both sides are grouped before the join, so no day is large when it is shuffled."""
    ordered = t.orders(spark, folder).groupBy(F.col("order_date").alias("day")).agg(rows().alias("ordered"))
    shipped = (
        t.table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("day"))
        .agg(rows().alias("shipped"))
    )
    return ordered.join(shipped, "day", "full")


@query(
    "join_semi",
    "SELECT user_id, name FROM usr WHERE EXISTS (SELECT 1 FROM events e WHERE e.user_id = usr.user_id)",
    "usr",
)
def join_semi(spark, folder):
    active = t.table(spark, folder, "events").select("user_id").distinct()
    return t.users(spark, folder).select("user_id", "name").join(active, "user_id", "left_semi")


@query(
    "join_anti",
    "SELECT user_id, name FROM usr WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = usr.user_id)",
    "usr",
)
def join_anti(spark, folder):
    active = t.table(spark, folder, "events").select("user_id").distinct()
    return t.users(spark, folder).select("user_id", "name").join(active, "user_id", "left_anti")


@query(
    "join_theta",
    f"""SELECT user_id, name, order_id, CAST(amount AS DOUBLE) AS amount, order_date, signup_date
        FROM usr JOIN ord USING (user_id) WHERE order_date >= signup_date""",
    "usr ord",
)
def join_theta(spark, folder):
    joined = t.users(spark, folder).join(t.orders(spark, folder), "user_id")
    return joined.filter(F.col("order_date") >= F.col("signup_date")).select(
        "user_id", "name", "order_id", F.col("amount").cast("double").alias("amount"), "order_date", "signup_date"
    )


# The age ranges of the band joins.
AGE_RANGES = "(VALUES ('Youth', 0, 25), ('Adult', 26, 40), ('Senior', 41, 100)) b(age_group, min_age, max_age)"
BAND_SQL = f"SELECT user_id, name, age, age_group FROM usr JOIN {AGE_RANGES} ON age BETWEEN min_age AND max_age"


def age_ranges(spark):
    return spark.sql(f"SELECT * FROM {AGE_RANGES}")


@query("join_range", BAND_SQL, "usr")
def join_range(spark, folder):
    found = joins.band_lookup(t.users(spark, folder), "age", age_ranges(spark), "min_age", "max_age", 20)
    return found.select("user_id", "name", "age", "age_group")


@query("join_range_bc", BAND_SQL, "usr")
def join_range_bc(spark, folder):
    found = joins.band_lookup_broadcast(
        t.users(spark, folder), "age", age_ranges(spark), "min_age", "max_age", 20, 10 * layout.MB
    )
    return found.select("user_id", "name", "age", "age_group")


def lines(spark, folder):
    return joins.order_lines(
        t.users(spark, folder),
        t.orders(spark, folder),
        t.order_details(spark, folder),
        t.products(spark, folder),
    )


def line_parts(spark, folder):
    """Partitions for the order lines: as many as their number asks for, which is read from the file footers."""
    return max(spark.sparkContext.defaultParallelism, layout.partitions_for_rows(t.order_details(spark, folder).count()))


LINES_SQL = """SELECT u.user_id, u.name AS user_name, o.order_id, o.amount, d.line, p.product_id,
  p.name AS product_name, p.category, d.quantity
  FROM usr u JOIN ord o ON u.user_id = o.user_id JOIN det d ON d.order_id = o.order_id
  JOIN prod p ON p.product_id = d.product_id"""


@query(
    "join_4way",
    f"SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM ({LINES_SQL})",
    "usr ord det prod",
)
def join_4way(spark, folder):
    return lines(spark, folder).select(
        "user_id", "user_name", "order_id", F.col("amount").cast("double").alias("amount"), "line",
        "product_id", "product_name", "category", "quantity",
    )


@query(
    "join_agg",
    f"""SELECT user_id, user_name, count(order_id) AS total_orders, CAST(sum(amount) AS DOUBLE) AS total_spent,
          count(DISTINCT product_id) AS unique_products,
          coalesce(string_agg(product_name, ',' ORDER BY product_name), '') AS purchased_products FROM ({LINES_SQL}) GROUP BY ALL""",
    "usr ord det prod",
)
def join_agg(spark, folder):
    summary = joins.purchases_per_user(lines(spark, folder), line_parts(spark, folder))
    return summary.withColumn("purchased_products", F.concat_ws(",", "purchased_products"))


@query(
    "join_agg_safe",
    f"""WITH l AS ({LINES_SQL})
        SELECT user_id, user_name, count(*) AS total_orders, CAST(sum(amount) AS DOUBLE) AS total_spent,
          max(unique_products) AS unique_products
        FROM (SELECT DISTINCT user_id, user_name, order_id, amount FROM l)
        JOIN (SELECT user_id, count(DISTINCT product_id) AS unique_products FROM l GROUP BY 1) USING (user_id)
        GROUP BY 1, 2""",
    "usr ord det prod",
)
def join_agg_safe(spark, folder):
    return joins.purchases_per_user_once(lines(spark, folder), line_parts(spark, folder))


@query(
    "join_agg_products",
    f"SELECT user_id, product_name, count(*) AS times FROM ({LINES_SQL}) GROUP BY ALL",
    "usr ord det prod",
)
def join_agg_products(spark, folder):
    return joins.purchased_products(lines(spark, folder), line_parts(spark, folder))


LINE_PRICE = """SELECT l_orderkey AS order_id, l_linenumber AS line, p_name AS name, p_retailprice AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey"""


@query("join_hint", LINE_PRICE)
def join_hint(spark, folder):
    """Products are sent to every task while they are small, and merged on the key beyond that."""
    products = t.products(spark, folder).select("product_id", "name", "price")
    side = layout.broadcast_when_small(products)
    details = t.order_details(spark, folder)
    details = details if side is not products else details.hint("merge")
    return details.join(side, "product_id").select("order_id", "line", "name", "price")


@query("join_copart", LINE_PRICE)
def join_copart(spark, folder):
    joined = joins.co_partitioned_join(
        t.order_details(spark, folder), t.products(spark, folder), "product_id", spread_by="order_id"
    )
    return joined.select("order_id", "line", "name", "price")


@query("join_pruned", LINE_PRICE)
def join_pruned(spark, folder):
    details = t.order_details(spark, folder).select("order_id", "line", "product_id")
    products = t.products(spark, folder).select("product_id", "name", "price")
    return details.join(products, "product_id").drop("product_id")


@query(
    "join_salted",
    "SELECT event_id, user_id, event_type, name FROM events JOIN usr USING (user_id)",
    "usr",
)
def join_salted(spark, folder):
    events = t.table(spark, folder, "events").select("event_id", "user_id", "event_type")
    users = t.users(spark, folder).select("user_id", "name")
    return joins.salted_join(events, users, "user_id", spread_by="event_id", share=0.007, parts=8)


@query(
    "join_fanout",
    """SELECT order_id, left_rows, right_rows, left_rows * right_rows AS output_rows
       FROM (SELECT order_id, count(*) AS left_rows FROM ord GROUP BY 1)
       JOIN (SELECT order_id, count(*) AS right_rows FROM det GROUP BY 1) USING (order_id)""",
    "ord det",
)
def join_fanout(spark, folder):
    return joins.fan_out(t.orders(spark, folder), t.order_details(spark, folder), "order_id")


@query(
    "join_dedup",
    "SELECT DISTINCT user_id, name, product_id FROM usr JOIN ord USING (user_id) JOIN det USING (order_id)",
    "usr ord det",
)
def join_dedup(spark, folder):
    bought = (
        t.orders(spark, folder)
        .select("order_id", "user_id")
        .join(t.order_details(spark, folder).select("order_id", "product_id"), "order_id")
        .select("user_id", "product_id")
        .dropDuplicates(["user_id", "product_id"])
    )
    return t.users(spark, folder).select("user_id", "name").join(bought, "user_id")


@query(
    "ref_integrity",
    """SELECT 'order without line' AS rule, count(*) AS orphans FROM orders
         WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
       UNION ALL
       SELECT 'line without order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
       UNION ALL
       SELECT 'customer without event', count(*) FROM customer
         WHERE c_custkey NOT IN (SELECT user_id FROM events)""",
)
def ref_integrity(spark, folder):
    orders, items = t.table(spark, folder, "orders"), t.table(spark, folder, "lineitem")
    checks = {
        "order without line": joins.orphans(orders, items, "o_orderkey", "l_orderkey"),
        "line without order": joins.orphans(items, orders, "l_orderkey", "o_orderkey"),
        "customer without event": joins.orphans(
            t.table(spark, folder, "customer"), t.table(spark, folder, "events"), "c_custkey", "user_id"
        ),
    }
    out = None
    for rule, found in checks.items():
        line = found.agg(rows().alias("orphans")).select(F.lit(rule).alias("rule"), "orphans")
        out = line if out is None else out.union(line)
    return out


# Aggregations.


@query(
    "agg_profile",
    """SELECT count(*) AS total_records, round(avg(amount), 6) AS amount_avg, min(amount) AS amount_min,
         max(amount) AS amount_max, round(stddev_samp(amount), 6) AS amount_stddev,
         count(DISTINCT event_type) AS event_type_distinct, count(DISTINCT category) AS category_distinct,
         count(DISTINCT session_id) AS session_id_distinct,
         min("timestamp") AS timestamp_earliest, max("timestamp") AS timestamp_latest FROM ev""",
    "ev",
)
def agg_profile(spark, folder):
    wanted = t.events(spark, folder).select(
        "event_id", "user_id", "timestamp", "event_type", "amount", "category", "session_id"
    )
    return aggregates.table_profile(wanted).withColumns(
        {"amount_avg": F.round("amount_avg", 6), "amount_stddev": F.round("amount_stddev", 6)}
    )


@query(
    "agg_group",
    """SELECT event_type, count(*) AS count, CAST(sum(m) AS DOUBLE) AS amount_sum,
         CAST(sum(m) AS DOUBLE) / count(amount) AS amount_avg, min(amount) AS amount_min, max(amount) AS amount_max,
         string_agg(DISTINCT category, ',' ORDER BY category) AS category_values FROM ev GROUP BY event_type""",
    "ev",
)
def agg_group(spark, folder):
    wanted = t.events(spark, folder).select("event_id", "user_id", "event_type", "category", "amount")
    out = aggregates.group_profile(wanted, ["event_type"], value_sets=("category",))
    return out.withColumn("category_values", F.array_join("category_values", ","))


AMOUNTS = "CAST(sum(m) AS DOUBLE) AS amount_sum, CAST(sum(m) AS DOUBLE) / count(amount) AS amount_avg, min(amount) AS amount_min, max(amount) AS amount_max"


@query(
    "agg_group_default",
    f"""SELECT event_type, category, log_type, count(*) AS count, {AMOUNTS} FROM ev GROUP BY 1, 2, 3
        ORDER BY count DESC, event_type, category, log_type LIMIT 10""",
    "ev",
)
def agg_group_default(spark, folder):
    """Grouped by every text column, the ten largest groups."""
    wanted = t.events(spark, folder).select("event_id", "user_id", "event_type", "category", "log_type", "amount")
    return aggregates.largest_groups(aggregates.group_profile(wanted), aggregates.default_keys(wanted))


@query(
    "agg_group_sets",
    f"""SELECT level, count(*) AS count, {AMOUNTS}, string_agg(DISTINCT category, ',' ORDER BY category) AS category_values,
          string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_type_values FROM ev GROUP BY 1""",
    "ev",
)
def agg_group_sets(spark, folder):
    """The values of all other text columns as sets."""
    wanted = t.events(spark, folder).select("event_id", "level", "event_type", "category", "amount")
    out = aggregates.group_profile(wanted, ["level"], value_sets=None)
    return out.withColumns({c: F.array_join(c, ",") for c in ("category_values", "event_type_values")})


@query(
    "agg_month",
    """SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
         count(*) AS count FROM ord GROUP BY 1, 2""",
    "ord",
)
def agg_month(spark, folder):
    return aggregates.monthly_counts(t.orders(spark, folder), "order_date")


@query(
    "agg_weekday",
    """SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS dayofweek, count(*) AS count, dayname(ts) AS day_name
       FROM events GROUP BY 1, 3""",
)
def agg_weekday(spark, folder):
    return aggregates.weekday_counts(t.table(spark, folder, "events"), "ts")


@query(
    "agg_quartiles",
    """SELECT event_type, quantile_disc(value, 0.25) AS value_q1, quantile_disc(value, 0.5) AS value_median,
         quantile_disc(value, 0.75) AS value_q3 FROM events GROUP BY 1""",
)
def agg_quartiles(spark, folder):
    return aggregates.quartiles(t.table(spark, folder, "events"), ["value"], ["event_type"])


@query(
    "agg_conditional",
    """SELECT CAST(sum(CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS positive_value_sum,
         count(*) FILTER (WHERE c_acctbal > 0) AS positive_value_count,
         count(*) FILTER (WHERE c_acctbal = 0) AS zero_value_count,
         CAST(sum(CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE)
           / count(*) FILTER (WHERE c_acctbal > 0) AS positive_value_avg
       FROM customer""",
)
def agg_conditional(spark, folder):
    return aggregates.sign_split(t.table(spark, folder, "customer"), "c_acctbal")


@query(
    "agg_distinct",
    """SELECT count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
         count(DISTINCT ip_address) AS addresses FROM ev""",
    "ev",
)
def agg_distinct(spark, folder):
    return t.events(spark, folder).agg(
        F.countDistinct("user_id").alias("users"),
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("ip_address").alias("addresses"),
    )


@query(
    "agg_collect",
    """SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types,
         (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM
            (SELECT event_type, count(*) AS n FROM events i WHERE i.user_id = o.user_id GROUP BY 1)) AS event_counts
       FROM events o GROUP BY user_id""",
)
def agg_collect(spark, folder):
    """Counted per type first: a list holds one entry per type, however many rows a user has."""
    counted = aggregates.value_list(t.table(spark, folder, "events"), ["user_id"], "event_type")
    entries = F.sort_array(F.collect_list(F.struct("event_type", "count")))
    return (
        counted.groupBy("user_id")
        .agg(F.sort_array(F.collect_set("event_type")).alias("types"), entries.alias("entries"))
        .select(
            "user_id",
            F.array_join("types", ",").alias("event_types"),
            F.array_join(
                F.transform("entries", lambda e: F.concat(e["event_type"], F.lit("="), e["count"].cast("string"))),
                ",",
            ).alias("event_counts"),
        )
    )


@query(
    "agg_first",
    """SELECT user_id, arg_min(category, ("timestamp", event_id)) AS first_category,
         arg_max(category, ("timestamp", event_id)) AS last_category FROM ev GROUP BY user_id""",
    "ev",
)
def agg_first(spark, folder):
    place = F.struct("timestamp", "event_id")
    return (
        t.events(spark, folder)
        .groupBy("user_id")
        .agg(
            F.min_by("category", place).alias("first_category"),
            F.max_by("category", place).alias("last_category"),
        )
    )


CUBE_MEASURES = """count(*) AS event_count, CAST(sum(m) AS DOUBLE) AS total_value,
  count(DISTINCT user_id) AS unique_users"""


@query(
    "agg_cube",
    f"""SELECT category, event_type, CAST(grouping_id(category, event_type) AS INTEGER) AS grouping_id,
        {CUBE_MEASURES} FROM ev GROUP BY CUBE (category, event_type)""",
    "ev",
)
def agg_cube(spark, folder):
    dims = ["category", "event_type"]
    small, measures = aggregates.reduced_per(t.events(spark, folder), dims, "user_id", "amount")
    return aggregates.cube(small, dims, measures)


@query(
    "agg_rollup",
    f"""SELECT category, event_type, CAST(grouping_id(category, event_type) AS INTEGER) AS grouping_id,
        {CUBE_MEASURES} FROM ev GROUP BY ROLLUP (category, event_type)""",
    "ev",
)
def agg_rollup(spark, folder):
    dims = ["category", "event_type"]
    small, measures = aggregates.reduced_per(t.events(spark, folder), dims, "user_id", "amount")
    return aggregates.rollup(small, dims, measures)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PIVOT_SQL = ", ".join(
    f"count(*) FILTER (WHERE event_type = '{e}') AS {e}_count, "
    f"CAST(sum(m) FILTER (WHERE event_type = '{e}') AS DOUBLE) AS {e}_total_amount"
    for e in EVENT_TYPES
)


@query("agg_pivot", f"SELECT category, {PIVOT_SQL} FROM ev GROUP BY category", "ev")
def agg_pivot(spark, folder):
    out = aggregates.count_and_amount_pivot(
        t.events(spark, folder), "category", "event_type", EVENT_TYPES, "amount"
    )
    return out.fillna(0, [f"{e}_count" for e in EVENT_TYPES])


@query(
    "agg_share",
    """SELECT status_code, count(*) AS count, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ev) AS percentage
       FROM ev WHERE status_code IS NOT NULL GROUP BY status_code""",
    "ev",
)
def agg_share(spark, folder):
    return aggregates.shares(t.events(spark, folder), ["status_code"], present="status_code")


@query(
    "agg_distribution",
    """SELECT 'month' AS dimension, strftime("timestamp", '%Y-%m') AS value, count(*) AS count FROM ev GROUP BY 2
       UNION ALL SELECT 'category', category, count(*) FROM ev GROUP BY 2
       UNION ALL SELECT 'event_type', event_type, count(*) FROM ev GROUP BY 2""",
    "ev",
)
def agg_distribution(spark, folder):
    """One scan: the three label columns are unfolded and counted together."""
    labels = F.explode(
        F.create_map(
            F.lit("month"), F.date_format("timestamp", "yyyy-MM"),
            F.lit("category"), F.col("category"),
            F.lit("event_type"), F.col("event_type"),
        )
    ).alias("dimension", "value")
    return t.events(spark, folder).select(labels).groupBy("dimension", "value").agg(rows().alias("count"))


@query(
    "agg_having",
    "SELECT user_id, count(*) AS total_events FROM events GROUP BY user_id HAVING count(*) > 60",
)
def agg_having(spark, folder):
    counted = t.table(spark, folder, "events").groupBy("user_id").agg(rows().alias("total_events"))
    return counted.filter(F.col("total_events") > 60)


@query(
    "agg_corr",
    """SELECT 'amount' AS a, 'user_id' AS b, round(corr(amount, user_id), 6) AS r FROM ev
       UNION ALL SELECT 'amount', 'hour', round(corr(amount, hour("timestamp")), 6) FROM ev
       UNION ALL SELECT 'user_id', 'hour', round(corr(user_id, hour("timestamp")), 6) FROM ev""",
    "ev",
)
def agg_corr(spark, folder):
    wanted = t.events(spark, folder).select("amount", "user_id", F.hour("timestamp").alias("hour"))
    return aggregates.correlations(wanted, ["amount", "user_id", "hour"]).withColumn("r", F.round("r", 6))


@query(
    "agg_histogram",
    """SELECT least(CAST(floor(20 * (value - lo) / (hi - lo)) AS BIGINT) + 1, 20) AS bin, count(*) AS count
       FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) GROUP BY 1""",
)
def agg_histogram(spark, folder):
    return aggregates.histogram(t.table(spark, folder, "events"), "value", 20)


HEAT_SQL = ", ".join(f"count(*) FILTER (WHERE hour(ts) = {h}) AS h{h:02d}" for h in range(24))


@query(
    "agg_heatmap",
    f"SELECT CAST(isodow(ts) - 1 AS INTEGER) AS weekday, dayname(ts) AS day_name, {HEAT_SQL} FROM events GROUP BY 1, 2",
)
def agg_heatmap(spark, folder):
    return aggregates.weekday_hour_table(t.table(spark, folder, "events"), "ts")


@query(
    "agg_category_share",
    """SELECT category, count(*) AS count, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ev) AS percentage
       FROM ev GROUP BY category""",
    "ev",
)
def agg_category_share(spark, folder):
    return aggregates.shares(t.events(spark, folder), ["category"])


@query(
    "agg_rollup_report",
    """WITH ips AS (SELECT ip_address, count(*) AS n FROM ev GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100),
       hours AS (SELECT log_type, date_trunc('hour', "timestamp") AS h, count(*) AS n FROM ev GROUP BY 1, 2)
       SELECT 'total_events' AS item, CAST(count(*) AS DOUBLE) AS value FROM ev
       UNION ALL SELECT 'total_unique_ips', CAST(sum(n) AS DOUBLE) FROM
         (SELECT count(DISTINCT ip_address) AS n FROM ev GROUP BY log_type)
       UNION ALL SELECT 'mean_per_hour ' || log_type, CAST(sum(n) AS DOUBLE) / count(*) FROM hours GROUP BY log_type
       UNION ALL SELECT 'max_per_hour ' || log_type, CAST(max(n) AS DOUBLE) FROM hours GROUP BY log_type
       UNION ALL SELECT 'error_rate', 100.0::DOUBLE * count(*) FILTER (WHERE status_code >= 400) / count(status_code) FROM ev
       UNION ALL SELECT 'top_10_ip_share',
         100.0::DOUBLE * (SELECT sum(n) FROM (SELECT n FROM ips ORDER BY n DESC, ip_address LIMIT 10))::DOUBLE / sum(n)::DOUBLE FROM ips""",
    "ev",
)
def agg_rollup_report(spark, folder):
    return log_reports.summary_of_reports(t.events(spark, folder))
