"""Ready-made batch analyses."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.plans import analytics
from sluice.queries.registry import query
from sluice.queries.relational import EVENT_TYPES
from sluice.sources import tables as t

TOTAL = "CAST(sum(m) AS DOUBLE)"
MEAN = "CAST(sum(m) AS DOUBLE) / count(m)"


@query(
    "biz_summary",
    f"""SELECT category, event_type, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
          {TOTAL} AS total_amount, {MEAN} AS avg_amount, quantile_disc(amount, 0.5) AS median_amount
        FROM ev GROUP BY 1, 2""",
    "ev",
)
def biz_summary(spark, folder):
    return analytics.business_summary(t.events(spark, folder))


@query(
    "biz_hourly",
    f"""SELECT CAST(hour("timestamp") AS INTEGER) AS hour, category, count(*) AS events_count,
          {TOTAL} AS hourly_revenue FROM ev GROUP BY 1, 2""",
    "ev",
)
def biz_hourly(spark, folder):
    return analytics.hourly_revenue(t.events(spark, folder))


@query(
    "user_summary",
    f"""SELECT user_id, count(*) AS total_events, {TOTAL} AS total_spent, {MEAN} AS avg_transaction,
          count(DISTINCT category) AS categories_used, count(DISTINCT event_type) AS event_types,
          string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_pattern FROM ev GROUP BY 1""",
    "ev",
)
def user_summary(spark, folder):
    out = analytics.user_summary(t.events(spark, folder))
    return out.withColumn("event_pattern", F.array_join("event_pattern", ","))


@query(
    "transitions",
    """SELECT event_type || '->' || nxt AS event_pair, count(*) AS count FROM (
         SELECT event_type, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
       WHERE nxt IS NOT NULL GROUP BY 1""",
)
def transitions(spark, folder):
    return analytics.transitions(t.events(spark, folder))


@query(
    "category_perf",
    f"""SELECT *, total_revenue / unique_customers AS revenue_per_customer,
          CAST(row_number() OVER (ORDER BY total_revenue DESC) AS INTEGER) AS revenue_rank,
          percent_rank() OVER (ORDER BY total_revenue DESC) AS revenue_percentile
        FROM (SELECT category, count(*) AS total_transactions, {TOTAL} AS total_revenue,
                {MEAN} AS avg_transaction_value, count(DISTINCT user_id) AS unique_customers,
                count(*) FILTER (WHERE event_type = 'purchase') * 100.0::DOUBLE / count(*) AS purchase_conversion_rate
              FROM ev GROUP BY 1)""",
    "ev",
)
def category_perf(spark, folder):
    return analytics.category_performance(t.events(spark, folder))


@query(
    "anomaly_global",
    """SELECT event_id, amount, round(abs(amount - mu) / sd, 6) AS z_score, abs(amount - mu) / sd > 2.5 AS is_anomaly,
         CASE WHEN amount > mu + sd * 2.5 THEN 'high' WHEN amount < mu - sd * 2.5 THEN 'low' ELSE 'normal' END
           AS anomaly_type
       FROM ev, (SELECT avg(amount) AS mu, stddev_samp(amount) AS sd FROM ev)""",
    "ev",
)
def anomaly_global(spark, folder):
    out = analytics.amount_outliers(t.events(spark, folder).select("event_id", "amount"))
    return out.withColumn("z_score", F.round("z_score", 6))


@query(
    "anomaly_type",
    """SELECT event_type, event_id, value, round(mu, 6) AS group_mean, round(sd, 6) AS group_stddev,
         round(abs(value - mu) / sd, 6) AS z_score
       FROM events JOIN (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events GROUP BY 1)
         USING (event_type) WHERE abs(value - mu) / sd > 3""",
)
def anomaly_type(spark, folder):
    raw = t.table(spark, folder, "events").select("event_type", "event_id", "value")
    out = analytics.outliers_per_group(raw, "event_type", "value")
    return out.withColumns({c: F.round(c, 6) for c in ("group_mean", "group_stddev", "z_score")})


@query(
    "funnel",
    """WITH u AS (SELECT event_type, count(DISTINCT user_id) AS unique_users FROM events
         WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1)
       SELECT CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS INTEGER) AS step, event_type,
         unique_users, unique_users * 100.0::DOUBLE / (SELECT unique_users FROM u WHERE event_type = 'view')
           AS percent_of_first FROM u""",
)
def funnel(spark, folder):
    return analytics.funnel(t.table(spark, folder, "events"), ["view", "click", "purchase"])


@query(
    "cohort_daily",
    f"""WITH f AS (SELECT user_id, CAST(min("timestamp") AS DATE) AS first_purchase_date FROM ev
          WHERE event_type = 'purchase' GROUP BY 1)
        SELECT first_purchase_date,
          CAST(datediff('day', first_purchase_date, CAST("timestamp" AS DATE)) AS INTEGER) AS days_since_first,
          count(DISTINCT user_id) AS active_users, {TOTAL} AS cohort_revenue
        FROM ev JOIN f USING (user_id) GROUP BY 1, 2""",
    "ev",
)
def cohort_daily(spark, folder):
    return analytics.purchase_cohorts(t.events(spark, folder))


@query(
    "quick_insights",
    f"""SELECT count(*) AS total_records, count(DISTINCT user_id) AS total_users, {TOTAL} AS total_revenue,
          {TOTAL} / count(DISTINCT user_id) AS revenue_per_user FROM ev""",
    "ev",
)
def quick_insights(spark, folder):
    return analytics.quick_insights(t.events(spark, folder))


SCORES = """SELECT h AS window_start, user_id, category, round(sum(w * exp(-age / 3600.0::DOUBLE)), 8) AS behavior_score,
         max("timestamp") AS last_activity
       FROM (SELECT *, date_trunc('hour', "timestamp") AS h,
               CAST(epoch(date_trunc('hour', "timestamp")) AS BIGINT) + 3600 - CAST(floor(epoch("timestamp")) AS BIGINT) AS age,
               CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.0 WHEN 'purchase' THEN 5.0 ELSE 0.0 END::DOUBLE AS w
             FROM ev) GROUP BY 1, 2, 3"""


@query("behavior_score", SCORES, "ev")
def behavior_score(spark, folder):
    out = analytics.behavior_score(t.events(spark, folder))
    return out.select(
        F.col("window.start").alias("window_start"), "user_id", "category",
        F.round("behavior_score", 8).alias("behavior_score"), "last_activity",
    )


@query(
    "rfm",
    """SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, user_id) AS r_score,
         ntile(5) OVER (ORDER BY frequency, user_id) AS f_score, ntile(5) OVER (ORDER BY monetary, user_id) AS m_score,
         ntile(5) OVER (ORDER BY recency_days DESC, user_id) || '-' || ntile(5) OVER (ORDER BY frequency, user_id)
           || '-' || ntile(5) OVER (ORDER BY monetary, user_id) AS segment
       FROM (SELECT user_id, CAST(datediff('day', CAST(max("timestamp") AS DATE),
               (SELECT CAST(max(ts) AS DATE) FROM events)) AS INTEGER) AS recency_days,
               count(*) AS frequency, CAST(sum(m) AS DOUBLE) AS monetary FROM ev GROUP BY 1)""",
    "ev",
)
def rfm(spark, folder):
    return analytics.rfm(t.events(spark, folder))


@query(
    "user_features",
    f"""SELECT user_id, count(*) AS n_events,
          {", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS n_{e}" for e in EVENT_TYPES)},
          {TOTAL} AS amount_sum, {MEAN} AS amount_mean, max(amount) AS amount_max,
          count(DISTINCT CAST("timestamp" AS DATE)) AS active_days, count(DISTINCT category) AS categories,
          min("timestamp") AS first_seen, max("timestamp") AS last_seen FROM ev GROUP BY 1""",
    "ev",
)
def user_features(spark, folder):
    return analytics.user_features(t.events(spark, folder), EVENT_TYPES)


@query(
    "daily_user_activity",
    f"""SELECT user_id, CAST("timestamp" AS DATE) AS date, event_type, count(*) AS event_count,
          {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev
        WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1, 2, 3""",
    "ev",
)
def daily_user_activity(spark, folder):
    return analytics.daily_user_activity(t.events(spark, folder), ["click", "view", "purchase"])


@query(
    "monthly_summary",
    f"""SELECT strftime("timestamp", '%Y-%m') AS month, category, count(DISTINCT user_id) AS active_users,
          count(*) AS total_events, {TOTAL} AS revenue, {MEAN} AS avg_value FROM ev GROUP BY 1, 2""",
    "ev",
)
def monthly_summary(spark, folder):
    return analytics.monthly_summary(t.events(spark, folder))


@query(
    "active_users",
    f"""SELECT user_id, count(DISTINCT event_type) AS distinct_events, count(*) AS total_events,
          {TOTAL} AS lifetime_value, arg_min(category, ("timestamp", event_id)) AS primary_category,
          max("timestamp") AS last_activity FROM ev GROUP BY 1 HAVING count(*) >= 5""",
    "ev",
)
def active_users(spark, folder):
    return analytics.active_users(t.events(spark, folder))


@query(
    "product_stats",
    f"""SELECT category, count(*) AS purchase_count, {TOTAL} AS total_revenue, {MEAN} AS avg_price,
          count(DISTINCT user_id) AS unique_buyers FROM ev WHERE event_type = 'purchase' GROUP BY 1""",
    "ev",
)
def product_stats(spark, folder):
    return analytics.purchase_statistics(t.events(spark, folder))


@query(
    "user_activity",
    f"""SELECT user_id, count(*) AS event_count, count(DISTINCT session_id) AS session_count, {TOTAL} AS total_value,
          {MEAN} AS avg_value, max("timestamp") AS last_activity,
          string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_types FROM ev GROUP BY 1""",
    "ev",
)
def user_activity(spark, folder):
    out = analytics.user_activity(t.events(spark, folder))
    return out.withColumn("event_types", F.array_join("event_types", ","))


@query(
    "hourly_trends",
    f"""SELECT strftime("timestamp", '%Y-%m-%d %H:00:00') AS hour, event_type, count(*) AS event_count,
          count(DISTINCT user_id) AS unique_users, {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev GROUP BY 1, 2""",
    "ev",
)
def hourly_trends(spark, folder):
    return analytics.hourly_trends(t.events(spark, folder))


@query(
    "hourly_trends_of_day",
    f"""SELECT CAST(hour("timestamp") AS INTEGER) AS hour, event_type, count(*) AS event_count,
          count(DISTINCT user_id) AS unique_users, {TOTAL} AS total_value, {MEAN} AS avg_value FROM ev GROUP BY 1, 2""",
    "ev",
)
def hourly_trends_of_day(spark, folder):
    return analytics.hourly_trends(t.events(spark, folder), dated=False)


@query(
    "trend_data",
    f"""SELECT CAST("timestamp" AS DATE) AS date, category, {TOTAL} AS total_amount, count(*) AS event_count
        FROM ev GROUP BY 1, 2""",
    "ev",
)
def trend_data(spark, folder):
    return analytics.category_trend(t.events(spark, folder))


@query(
    "daily_sales",
    f"""SELECT CAST("timestamp" AS DATE) AS date, {TOTAL} AS daily_sales FROM ev
        WHERE event_type = 'purchase' GROUP BY 1""",
    "ev",
)
def daily_sales(spark, folder):
    return analytics.daily_sales(t.events(spark, folder))


@query(
    "dashboard_data",
    f"""SELECT 'daily_revenue' AS section, CAST(CAST("timestamp" AS DATE) AS VARCHAR) AS item, {TOTAL} AS value
          FROM ev GROUP BY 2
        UNION ALL SELECT 'category_shares', category, count(*) * 100.0::DOUBLE / (SELECT count(*) FROM ev) FROM ev GROUP BY 2
        UNION ALL SELECT 'heat_table', d || ' ' || lpad(CAST(h AS VARCHAR), 2, '0'), CAST(coalesce(n, 0) AS DOUBLE) FROM
          (SELECT * FROM (SELECT DISTINCT dayname("timestamp") AS d FROM ev), (SELECT unnest(range(24)) AS h))
          LEFT JOIN (SELECT dayname("timestamp") AS d, hour("timestamp") AS h, count(*) AS n FROM ev GROUP BY 1, 2) USING (d, h)
        UNION ALL (SELECT 'top_users', CAST(user_id AS VARCHAR), {TOTAL} FROM ev GROUP BY 2, user_id
          ORDER BY 3 DESC, user_id LIMIT 10)""",
    "ev",
)
def dashboard_data(spark, folder):
    return analytics.dashboard(t.events(spark, folder))


LIVE = f"count(*) AS events, count(DISTINCT user_id) AS users, {TOTAL} AS amount"


LIVE_SQL = f"""WITH d AS (SELECT * FROM ev WHERE CAST("timestamp" AS DATE) = DATE '2024-01-30')
        SELECT 'total' AS section, 'all' AS item, {LIVE} FROM d
        UNION ALL (SELECT 'category', category, {LIVE} FROM d GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)
        UNION ALL SELECT 'event_type', event_type, {LIVE} FROM d GROUP BY 2"""


@query("live_metrics", LIVE_SQL, "ev")
def live_metrics(spark, folder):
    return analytics.live_metrics(t.events(spark, folder), F.lit("2024-01-30").cast("date"))
