"""Window functions over series and over raw rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.functions.values import rows
from sluice.operators import ordered, windows
from sluice.queries.registry import query
from sluice.session import settled
from sluice.sources import tables as t

PLACE = ["salesperson", "region", "month"]
SERIES = ["salesperson", "region"]
BY_SERIES = "PARTITION BY salesperson, region ORDER BY month"


@query(
    "win_rownum",
    """SELECT *, row_number() OVER (ORDER BY sales DESC, salesperson, region, month) AS overall_rank FROM sales""",
    "sales",
)
def win_rownum(spark, folder):
    return ordered.row_numbers(settled(t.sales(spark, folder)), "sales", PLACE, descending=True, name="overall_rank")


@query(
    "win_rownum_events",
    """SELECT *, row_number() OVER (ORDER BY value DESC NULLS LAST, event_id) AS position
       FROM (SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN value END AS value FROM events)""",
)
def win_rownum_events(spark, folder):
    """Every tenth row has no value and comes after all others."""
    raw = t.table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 10 != 3, F.col("value")).alias("value"))
    return ordered.row_numbers(raw, "value", ["event_id"], descending=True)


@query(
    "win_dense_rank",
    """SELECT *, dense_rank() OVER (ORDER BY amount DESC NULLS LAST) AS dense_rank
       FROM (SELECT event_id, CASE WHEN event_id % 10 <> 3 THEN amount END AS amount FROM ev)""",
    "ev",
)
def win_dense_rank(spark, folder):
    """Every tenth row has no amount; it keeps its row and ranks last."""
    events = t.events(spark, folder).select("event_id", F.when(F.col("event_id") % 10 != 3, F.col("amount")).alias("amount"))
    ranks = ordered.value_ranks(events, "amount", descending=True)
    return ordered.with_ranks(events, ranks.select("amount", "dense_rank"), "amount")


@query(
    "win_percent_rank",
    """SELECT *, rank() OVER (ORDER BY sales DESC) AS rank,
         percent_rank() OVER (ORDER BY sales DESC) AS percent_rank FROM sales""",
    "sales",
)
def win_percent_rank(spark, folder):
    sales = settled(t.sales(spark, folder))
    ranks = ordered.value_ranks(sales, "sales", descending=True)
    return ordered.with_ranks(sales, ranks.select("sales", "rank", "percent_rank"), "sales")


@query(
    "win_group_rank",
    """SELECT *, row_number() OVER (PARTITION BY region ORDER BY sales DESC, salesperson, month) AS region_rank,
         row_number() OVER (PARTITION BY region, month ORDER BY sales DESC, salesperson) AS monthly_region_rank,
         rank() OVER (PARTITION BY region ORDER BY sales DESC) AS region_level FROM sales""",
    "sales",
)
def win_group_rank(spark, folder):
    by_region = windows.group_ranks(t.sales(spark, folder), ["region"], "sales", ["salesperson", "month"])
    named = by_region.withColumnsRenamed({"group_position": "region_rank", "group_rank": "region_level"})
    by_month = windows.group_ranks(named, ["region", "month"], "sales", ["salesperson"])
    return by_month.withColumnRenamed("group_position", "monthly_region_rank").drop("group_rank")


@query(
    "win_lag_lead",
    f"""SELECT *, lag(sales) OVER ({BY_SERIES}) AS previous, lead(sales) OVER ({BY_SERIES}) AS next FROM sales""",
    "sales",
)
def win_lag_lead(spark, folder):
    out = windows.neighbours(t.sales(spark, folder), SERIES, "month", "sales")
    return out.select(*PLACE, "sales", "previous", "next")


@query(
    "win_first_last",
    f"""SELECT *, first_value(sales) OVER ({BY_SERIES}) AS first, last_value(sales) OVER ({BY_SERIES}) AS last_so_far,
          last_value(sales) OVER ({BY_SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_of_all
        FROM sales""",
    "sales",
)
def win_first_last(spark, folder):
    out = windows.neighbours(t.sales(spark, folder), SERIES, "month", "sales")
    return out.select(*PLACE, "sales", "first", "last_so_far", "last_of_all")


@query(
    "win_growth",
    f"""SELECT *, (sales - lag(sales) OVER w) * 100.0::DOUBLE / lag(sales) OVER w AS growth_percent,
          (sales - first_value(sales) OVER w) * 100.0::DOUBLE / first_value(sales) OVER w AS growth_since_first
        FROM sales WINDOW w AS ({BY_SERIES})""",
    "sales",
)
def win_growth(spark, folder):
    out = windows.neighbours(t.sales(spark, folder), SERIES, "month", "sales")
    return out.select(*PLACE, "sales", "growth_percent", "growth_since_first")


@query(
    "win_running",
    """SELECT *, CAST(sum(CAST(sales AS DECIMAL(18,2))) OVER w AS DOUBLE) AS running_total,
         CAST(sum(CAST(sales AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(sales) OVER w AS running_mean
       FROM sales WINDOW w AS (PARTITION BY salesperson ORDER BY month)""",
    "sales",
)
def win_running(spark, folder):
    return windows.running(t.sales(spark, folder), ["salesperson"], "month", "sales")


@query(
    "win_moving3",
    f"""SELECT *, CAST(sum(CAST(sales AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(sales) OVER w AS moving_avg_3m
        FROM sales WINDOW w AS ({BY_SERIES} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "sales",
)
def win_moving3(spark, folder):
    return windows.moving_mean(t.sales(spark, folder), SERIES, "month", "sales", 3, "moving_avg_3m")


@query(
    "win_contribution",
    """SELECT *, CAST(sum(CAST(sales AS DECIMAL(18,2))) OVER w AS DOUBLE) AS group_total,
         CAST(sum(CAST(sales AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w AS group_mean,
         sales / (CAST(sum(CAST(sales AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(*) OVER w) AS to_group_mean,
         sales * 100.0::DOUBLE / CAST(sum(CAST(sales AS DECIMAL(18,2))) OVER w AS DOUBLE) AS share_percent
       FROM sales WINDOW w AS (PARTITION BY region)""",
    "sales",
)
def win_contribution(spark, folder):
    return windows.contribution(t.sales(spark, folder), "region", "sales")


BY_SYMBOL = "PARTITION BY symbol ORDER BY date"


@query(
    "win_change",
    f"""SELECT *, lag(price) OVER w AS previous, price - lag(price) OVER w AS change,
          (price - lag(price) OVER w) * 100.0::DOUBLE / lag(price) OVER w AS change_percent
        FROM stock WINDOW w AS ({BY_SYMBOL})""",
    "stock",
)
def win_change(spark, folder):
    return windows.changes(t.stock(spark, folder), ["symbol"], "date", "price")


@query(
    "win_volatility",
    f"""SELECT symbol, date, price, round(avg(price) OVER w, 6) AS moving_mean, min(price) OVER w AS moving_min,
          max(price) OVER w AS moving_max, round(stddev_samp(price) OVER w, 6) AS moving_stddev,
          round(price / avg(price) OVER w, 6) AS to_mean
        FROM stock WINDOW w AS ({BY_SYMBOL} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "stock",
)
def win_volatility(spark, folder):
    out = windows.volatility(t.stock(spark, folder), ["symbol"], "date", "price", 5)
    return out.withColumns({c: F.round(c, 6) for c in ("moving_mean", "moving_stddev", "to_mean")})


@query(
    "win_range_days",
    f"""SELECT *, round(avg(price) OVER w, 6) AS mean_3d, count(price) OVER w AS n_3d FROM stock
        WINDOW w AS ({BY_SYMBOL} RANGE BETWEEN INTERVAL 3 DAYS PRECEDING AND CURRENT ROW)""",
    "stock",
)
def win_range_days(spark, folder):
    frame = windows.days_back(["symbol"], "date", 3)
    return t.stock(spark, folder).selectExpr(
        "*", f"round(avg(price) OVER {frame}, 6) AS mean_3d", f"count(price) OVER {frame} AS n_3d"
    )


@query(
    "win_frames",
    f"""SELECT *, max(price) OVER ({BY_SYMBOL} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS back_two,
          max(price) OVER ({BY_SYMBOL} ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS ahead_two,
          max(price) OVER ({BY_SYMBOL} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS around,
          max(price) OVER ({BY_SYMBOL} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far,
          max(price) OVER ({BY_SYMBOL} RANGE BETWEEN INTERVAL 1 DAYS PRECEDING AND CURRENT ROW) AS day_back,
          max(price) OVER ({BY_SYMBOL} RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS week_back,
          max(price) OVER (PARTITION BY symbol) AS of_all
        FROM stock""",
    "stock",
)
def win_frames(spark, folder):
    w = Window.partitionBy("symbol").orderBy("date")
    best = F.max("price")
    out = t.stock(spark, folder).select(
        "*",
        best.over(w.rowsBetween(-2, 0)).alias("back_two"),
        best.over(w.rowsBetween(0, 2)).alias("ahead_two"),
        best.over(w.rowsBetween(-1, 1)).alias("around"),
        best.over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
        best.over(w.rangeBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("of_all"),
    )
    one, seven = (windows.days_back(["symbol"], "date", n) for n in (1, 7))
    return out.selectExpr(
        "*", f"max(price) OVER {one} AS day_back", f"max(price) OVER {seven} AS week_back"
    )


@query(
    "topn_group",
    """SELECT user_id, event_id, amount, position FROM (
         SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY amount DESC, event_id) AS INTEGER) AS position
         FROM ev) WHERE position <= 3""",
    "ev",
)
def topn_group(spark, folder):
    raw = t.events(spark, folder).select("user_id", "event_id", "amount")
    return windows.top_per_group(raw, ["user_id"], [F.desc("amount"), F.col("event_id")], 3)


@query(
    "win_patterns",
    """SELECT d, n, CAST(sum(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative,
         avg(n) OVER (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS smoothed
       FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1)""",
)
def win_patterns(spark, folder):
    """The windows run over one row per day."""
    daily = t.table(spark, folder, "events").groupBy(F.to_date("ts").alias("d")).agg(rows().alias("n"))
    w = Window.orderBy("d")
    return daily.withColumns(
        {
            "cumulative": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "smoothed": F.avg("n").over(w.rowsBetween(-6, 0)),
        }
    )


@query(
    "daily_trends_ma7",
    """SELECT date, category, daily_events, CAST(revenue AS DOUBLE) AS daily_revenue, daily_active_users,
         avg(daily_events) OVER w AS events_ma, CAST(sum(revenue) OVER w AS DOUBLE) / count(*) OVER w AS revenue_ma,
         avg(daily_active_users) OVER w AS users_ma
       FROM (SELECT CAST("timestamp" AS DATE) AS date, category, count(*) AS daily_events, sum(m) AS revenue,
               count(DISTINCT user_id) AS daily_active_users FROM ev GROUP BY 1, 2)
       WINDOW w AS (PARTITION BY category ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "ev",
)
def daily_trends_ma7(spark, folder):
    return windows.daily_trends(t.events(spark, folder), "category", "timestamp", "amount", 7)


@query(
    "hourly_trend_ma3",
    """SELECT hour, events, CAST(r AS DOUBLE) AS revenue, active_users, avg(events) OVER w AS events_ma,
         CAST(sum(r) OVER w AS DOUBLE) / count(*) OVER w AS revenue_ma
       FROM (SELECT date_trunc('hour', ts) AS hour, count(*) AS events, sum(CAST(value AS DECIMAL(18,2))) AS r,
               count(DISTINCT user_id) AS active_users FROM events GROUP BY 1)
       WINDOW w AS (ORDER BY hour ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
def hourly_trend_ma3(spark, folder):
    return windows.hourly_trend(t.table(spark, folder, "events"), "ts", "value", 3)


@query(
    "user_sequence",
    """SELECT user_id, event_id, "timestamp", event_type, amount, row_number() OVER w AS event_sequence,
         lag(event_type) OVER w AS previous_event, lag(amount) OVER w AS previous_amount,
         (CAST(floor(epoch("timestamp")) AS BIGINT) - CAST(floor(epoch(lag("timestamp") OVER w)) AS BIGINT)) / 60.0::DOUBLE
           AS minutes_since_previous
       FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY "timestamp", event_id)""",
    "ev",
)
def user_sequence(spark, folder):
    raw = t.events(spark, folder).select("user_id", "event_id", "timestamp", "event_type", "amount")
    return windows.user_sequence(raw)


@query(
    "win_range_hour",
    """SELECT event_id, event_type, value, count(value) OVER w AS moving_count,
         CAST(sum(CAST(value AS DECIMAL(18,2))) OVER w AS DOUBLE) / count(value) OVER w AS moving_mean,
         round(stddev_samp(value) OVER w, 6) AS moving_stddev
       FROM events
       WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
)
def win_range_hour(spark, folder):
    raw = t.table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    out = ordered.moving_statistics(raw, ["event_type"], "ts", "value", 3600)
    return out.select(
        "event_id", "event_type", "value", "moving_count", "moving_mean",
        F.round("moving_stddev", 6).alias("moving_stddev"),
    )
