"""Ready-made batch analyses over lake events (user_id, timestamp, event_type, category, amount)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.times import day, hour_label, micros, month_label, weekday_name
from sluice.functions.values import col, combined_total, mean, partial_total, percent, ratio, rows, total
from sluice.operators.joins import with_group_values
from sluice.operators.ordered import SLICE_ROWS, hot_slices, ordered_scan, quantiles, tiles


def business_summary(events: DataFrame) -> DataFrame:
    """Figures per category and event type, with the exact median amount (of two middle ones the lower)."""
    keys = ["category", "event_type"]
    figures = events.groupBy(*keys).agg(
        rows().alias("total_events"),
        F.countDistinct("user_id").alias("unique_users"),
        total("amount").alias("total_amount"),
        mean("amount").alias("avg_amount"),
    )
    medians = quantiles(events, keys, "amount", {"median_amount": 0.5}).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.col("category").eqNullSafe(F.col("_category")) & F.col("event_type").eqNullSafe(F.col("_event_type"))
    return (
        figures.join(medians, same)
        .drop("_category", "_event_type")
        .orderBy(F.desc("total_amount"), "category", "event_type")
    )


def hourly_revenue(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("timestamp").alias("hour"), "category").agg(
        rows().alias("events_count"), total("amount").alias("hourly_revenue")
    )


def user_summary(events: DataFrame) -> DataFrame:
    """Figures per user. Categories and event types are small vocabularies, so their sets are
    counted in one pass."""
    return events.groupBy("user_id").agg(
        rows().alias("total_events"),
        total("amount").alias("total_spent"),
        mean("amount").alias("avg_transaction"),
        F.size(F.collect_set("category")).cast("bigint").alias("categories_used"),
        F.size(F.collect_set("event_type")).cast("bigint").alias("event_types"),
        F.sort_array(F.collect_set("event_type")).alias("event_pattern"),
    )


def transitions(events: DataFrame, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """How often one event type directly follows another within a user."""
    slim = events.select("user_id", "event_id", "timestamp", "event_type", micros("timestamp").alias("_us"))
    flagged, slices = hot_slices(slim, ["user_id"], "_us", "event_id", slice_rows=slice_rows)
    followed = ordered_scan(
        flagged,
        ["user_id"],
        ["timestamp", "event_id"],
        slices,
        following={"_next": "event_type"},
    )
    pair = F.concat("event_type", F.lit("->"), "_next")
    return (
        followed.filter(F.col("_next").isNotNull())
        .groupBy(pair.alias("event_pair"))
        .agg(rows().alias("count"))
        .orderBy(F.desc("count"), "event_pair")
    )


def category_performance(events: DataFrame) -> DataFrame:
    """Revenue, customers and conversion per category, ranked. The ranks run over one row each."""
    per_category = events.groupBy("category").agg(
        rows().alias("total_transactions"),
        total("amount").alias("total_revenue"),
        mean("amount").alias("avg_transaction_value"),
        F.countDistinct("user_id").alias("unique_customers"),
        percent(F.count_if(F.col("event_type") == "purchase"), rows()).alias("purchase_conversion_rate"),
    )
    turn = Window.orderBy(F.desc("total_revenue"), "category")
    return per_category.withColumns(
        {
            "revenue_per_customer": ratio("total_revenue", "unique_customers"),
            "revenue_rank": F.row_number().over(turn),
            "revenue_percentile": F.percent_rank().over(turn),
        }
    )


def amount_outliers(events: DataFrame, limit: float = 2.5) -> DataFrame:
    """z-score of every amount against the whole table, with the side it is off to."""
    stats = events.agg(F.struct(F.avg("amount").alias("mean"), F.stddev_samp("amount").alias("dev"))).scalar()
    side = (
        F.when(F.col("amount") > stats["mean"] + stats["dev"] * limit, "high")
        .when(F.col("amount") < stats["mean"] - stats["dev"] * limit, "low")
        .otherwise("normal")
    )
    z = F.abs(F.try_divide(F.col("amount") - stats["mean"], stats["dev"]))
    scored = events.withColumns({"z_score": z, "anomaly_type": side})
    return scored.withColumn("is_anomaly", F.col("z_score") > limit)


def outliers_per_group(events: DataFrame, group: str, value: str, limit: float = 3.0) -> DataFrame:
    """Rows more than ``limit`` deviations away from the mean of their group."""
    stats = events.groupBy(group).agg(F.avg(value).alias("group_mean"), F.stddev_samp(value).alias("group_stddev"))
    scored = with_group_values(events, [group], stats)
    z = F.abs(F.try_divide(F.col(value) - F.col("group_mean"), F.col("group_stddev")))
    return scored.withColumn("z_score", z).filter(F.col("z_score") > limit)


def funnel(events: DataFrame, steps: list[str]) -> DataFrame:
    """Distinct users per step, in percent of the first step."""
    users = (
        events.filter(F.col("event_type").isin(steps))
        .groupBy("event_type")
        .agg(F.countDistinct("user_id").alias("unique_users"))
    )
    first = users.filter(F.col("event_type") == steps[0]).agg(F.max("unique_users")).scalar()
    place = F.array_position(F.array(*[F.lit(s) for s in steps]), F.col("event_type"))
    return users.select(
        place.cast("int").alias("step"), "event_type", "unique_users",
        percent("unique_users", first).alias("percent_of_first"),
    ).orderBy("step")


def purchase_cohorts(events: DataFrame) -> DataFrame:
    """Users grouped by the day of their first purchase: activity and revenue by days since then."""
    first = (
        events.filter(F.col("event_type") == "purchase")
        .groupBy("user_id")
        .agg(day(F.min("timestamp")).alias("first_purchase_date"))
    )
    dated = events.select("user_id", "timestamp", "amount").join(first, "user_id")
    since = F.datediff(day("timestamp"), "first_purchase_date").alias("days_since_first")
    return dated.groupBy("first_purchase_date", since).agg(
        F.countDistinct("user_id").alias("active_users"), total("amount").alias("cohort_revenue")
    )


def quick_insights(events: DataFrame) -> DataFrame:
    return events.agg(
        rows().alias("total_records"),
        F.countDistinct("user_id").alias("total_users"),
        total("amount").alias("total_revenue"),
    ).withColumn("revenue_per_user", ratio("total_revenue", "total_users"))


# What an event type adds to a user's interest in a category.
BEHAVIOR_WEIGHTS = {"view": 1.0, "click": 2.0, "purchase": 5.0}


def decayed_interest(events: DataFrame, decay_seconds: float = 3600.0) -> DataFrame:
    """Interest per user, category and hour, as it stands at the end of the hour.

    Works on tables and streams: every event counts by its distance to the end of its hour, which does not change, so an
    event is added once and forgotten. Sums are exact, so they do not depend on the order of arrival.
    """
    framed = events.filter(F.col("category").isNotNull()).select(
        "user_id", "category", "event_type", "timestamp", F.window("timestamp", "1 hour").alias("window")
    )
    age = F.unix_timestamp("window.end") - F.unix_timestamp("timestamp")
    weight = F.lit(0.0)
    for event_type, points in BEHAVIOR_WEIGHTS.items():
        weight = F.when(F.col("event_type") == event_type, points).otherwise(weight)
    part = (weight * F.exp(-age / F.lit(decay_seconds))).cast("decimal(28,18)")
    return framed.groupBy("window", "user_id", "category").agg(F.sum(part).alias("interest"), F.max("timestamp").alias("last_activity"))


def behavior_score(events: DataFrame, as_of: Column | None = None, decay_seconds: float = 3600.0) -> DataFrame:
    """Interest per user, category and hour, fading with the age of each event; for tables and streams.

    Ages count back from ``as_of``, or from the end of the hour, which is when a live window
    would be read. All events of an hour fade by the same factor from its end on.
    """
    faded = F.col("interest").cast("double")
    if as_of is not None:
        faded = faded * F.exp((F.unix_timestamp("window.end") - F.unix_timestamp(as_of)) / F.lit(decay_seconds))
    return decayed_interest(events, decay_seconds).select("window", "user_id", "category", faded.alias("behavior_score"), "last_activity")


def rfm(events: DataFrame, buckets: int = 5, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Recency, frequency and amount per user, each cut into equal buckets (the best is highest).

    The three orders are found together: a row per user and measure, numbered within the measure.
    """
    seen = events.groupBy("user_id").agg(F.max("timestamp").alias("_last"), rows().alias("frequency"), total("amount").alias("monetary"))
    facts = seen.agg(F.struct(F.max("_last").alias("latest"), rows().alias("users"))).scalar()
    people = seen.select("user_id", F.datediff(facts["latest"], "_last").alias("recency_days"), "frequency", "monetary", facts["users"].alias("_users"))

    def measure(name: str, by: Column, none: Column) -> Column:
        return F.struct(F.lit(name).alias("_measure"), none.alias("_none"), by.cast("double").alias("_by"))

    # The longest time since the last event comes first; rows without one come last there, as a descending order has it.
    recency = measure("r", -F.col("recency_days"), F.col("recency_days").isNull())
    others = [measure(n, F.col(c), F.lit(False)) for n, c in (("f", "frequency"), ("m", "monetary"))]
    ranked = people.select("*", F.inline(F.array(recency, *others)))
    flagged, slices = hot_slices(ranked, ["_measure"], "_by", "user_id", slice_rows=slice_rows)
    if slices is not None:
        slices = F.when(F.col("_none"), F.lit(2**62)).otherwise(slices)
    placed = ordered_scan(flagged, ["_measure"], ["_none", "_by", "user_id"], slices, sums={"_position": F.lit(1)})
    tile = tiles(F.col("_position"), F.col("_users"), buckets)
    scores = [F.max(F.when(F.col("_measure") == n, tile)).alias(f"{n}_score") for n in "rfm"]
    scored = placed.groupBy("user_id").agg(*[F.max(c).alias(c) for c in ("recency_days", "frequency", "monetary")], *scores)
    return scored.withColumn("segment", F.concat_ws("-", "r_score", "f_score", "m_score"))


def user_features(events: DataFrame, event_types: list[str]) -> DataFrame:
    """One wide row per user, for use as model input."""
    per_type = [F.count_if(F.col("event_type") == e).alias(f"n_{e}") for e in event_types]
    return events.groupBy("user_id").agg(
        rows().alias("n_events"),
        *per_type,
        total("amount").alias("amount_sum"),
        mean("amount").alias("amount_mean"),
        F.max("amount").alias("amount_max"),
        F.countDistinct(day("timestamp")).alias("active_days"),
        F.countDistinct("category").alias("categories"),
        F.min("timestamp").alias("first_seen"),
        F.max("timestamp").alias("last_seen"),
    )


def daily_user_activity(events: DataFrame, event_types: list[str]) -> DataFrame:
    return (
        events.filter(F.col("event_type").isin(event_types))
        .groupBy("user_id", day("timestamp").alias("date"), "event_type")
        .agg(rows().alias("event_count"), total("amount").alias("total_value"), mean("amount").alias("avg_value"))
        .orderBy("user_id", "date", "event_type")
    )


def monthly_summary(events: DataFrame) -> DataFrame:
    return events.groupBy(month_label("timestamp").alias("month"), "category").agg(
        F.countDistinct("user_id").alias("active_users"),
        rows().alias("total_events"),
        total("amount").alias("revenue"),
        mean("amount").alias("avg_value"),
    )


def active_users(events: DataFrame, at_least: int = 5) -> DataFrame:
    """Users with enough events; the primary category is that of their earliest event."""
    place = F.struct("timestamp", "event_id")
    return (
        events.groupBy("user_id")
        .agg(
            F.countDistinct("event_type").alias("distinct_events"),
            rows().alias("total_events"),
            total("amount").alias("lifetime_value"),
            F.min_by("category", place).alias("primary_category"),
            F.max("timestamp").alias("last_activity"),
        )
        .filter(F.col("total_events") >= at_least)
    )


def purchase_statistics(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("event_type") == "purchase")
        .groupBy("category")
        .agg(
            rows().alias("purchase_count"),
            total("amount").alias("total_revenue"),
            mean("amount").alias("avg_price"),
            F.countDistinct("user_id").alias("unique_buyers"),
        )
    )


def user_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(
        rows().alias("event_count"),
        F.countDistinct("session_id").alias("session_count"),
        total("amount").alias("total_value"),
        mean("amount").alias("avg_value"),
        F.max("timestamp").alias("last_activity"),
        F.sort_array(F.collect_set("event_type")).alias("event_types"),
    )


def hourly_trends(events: DataFrame, dated: bool = True) -> DataFrame:
    """By event type and hour: of each date, or of the day over all dates."""
    hour = hour_label("timestamp") if dated else F.hour("timestamp")
    return events.groupBy(hour.alias("hour"), "event_type").agg(
        rows().alias("event_count"),
        F.countDistinct("user_id").alias("unique_users"),
        total("amount").alias("total_value"),
        mean("amount").alias("avg_value"),
    )


def category_trend(events: DataFrame, categories: int = 5) -> DataFrame:
    """Daily amount and count of the first categories by name."""
    names = events.select("category").distinct().orderBy("category").limit(categories)
    chosen = events.join(F.broadcast(names), "category", "left_semi")
    return chosen.groupBy(day("timestamp").alias("date"), "category").agg(
        total("amount").alias("total_amount"), rows().alias("event_count")
    )


def daily_sales(events: DataFrame) -> DataFrame:
    return (
        events.filter(F.col("event_type") == "purchase")
        .groupBy(day("timestamp").alias("date"))
        .agg(total("amount").alias("daily_sales"))
        .orderBy("date")
    )


def dashboard(events: DataFrame, top: int = 10) -> DataFrame:
    """The four tables of a business dashboard as ``section, item, value``, from all rows.

    Revenue by day, shares by category and the table of weekdays and hours come from one aggregation by hour
    and category; the users are read by themselves, as only the first of them are wanted.
    """
    parts = events.groupBy(day("timestamp").alias("date"), F.hour("timestamp").alias("hour"), "category").agg(rows().alias("_rows"), *partial_total("amount"))
    keys = [F.col(c) for c in ("date", "category", "day_name", "hour")]
    # The grouping number has a bit per column that is left out, the last column lowest.
    days, categories, cells = 0b0111, 0b1011, 0b1100
    grouped = (
        parts.withColumn("day_name", weekday_name(F.dayofweek("date")))
        .groupingSets([[keys[0]], [keys[1]], keys[2:]], *keys)
        .agg(F.grouping_id().alias("_set"), F.sum("_rows").alias("_n"), combined_total().alias("_amount"))
    )
    at_hour = [F.coalesce(F.sum(F.when(F.col("hour") == h, F.col("_n"))), F.lit(0)).alias(f"h{h:02d}") for h in range(24)]
    lines = grouped.groupBy("_set", "date", "category", "day_name").agg(F.sum("_n").alias("_n"), F.max("_amount").alias("_amount"), *at_hour)
    # A row per day, category and weekday is left, which one task can hold.
    all_rows = F.sum("_n").over(Window.partitionBy("_set"))
    lines = lines.withColumn("_share", percent("_n", all_rows))

    def line(section: str, item: Column, value: Column | str) -> Column:
        return F.struct(F.lit(section).alias("section"), item.cast("string").alias("item"), col(value).cast("double").alias("value"))

    per_hour = F.array(*[line("heat_table", F.concat_ws(" ", "day_name", F.lit(f"{h:02d}")), f"h{h:02d}") for h in range(24)])
    told = (
        F.when(F.col("_set") == days, F.array(line("daily_revenue", F.col("date"), "_amount")))
        .when(F.col("_set") == categories, F.array(line("category_shares", F.col("category"), "_share")))
        .when(F.col("_set") == cells, per_hour)
    )
    spent = events.groupBy("user_id").agg(total("amount").alias("amount")).orderBy(F.desc("amount"), "user_id").limit(top)
    return lines.select(F.inline(told)).union(spent.select(F.inline(F.array(line("top_users", F.col("user_id"), "amount")))))


def live_metrics(events: DataFrame, date: Column) -> DataFrame:
    """Totals of one day, with its five busiest categories and its event types, as one table."""
    day_start = date.cast("timestamp_ntz")
    day_end = F.date_add(date, 1).cast("timestamp_ntz")
    return day_metrics(day_parts(events.filter((F.col("timestamp") >= day_start) & (F.col("timestamp") < day_end))))


def day_parts(events: DataFrame, *keys: Column | str) -> DataFrame:
    """What the live metrics are made of: a row per user, category and event type. For tables and streams."""
    return events.groupBy(*keys, "user_id", "category", "event_type").agg(rows().alias("_rows"), *partial_total("amount"))


def day_metrics(parts: DataFrame, busiest: int = 5) -> DataFrame:
    """The live metrics from these rows, which are read once for all sections."""
    sets = parts.groupingSets([[], [F.col("category")], [F.col("event_type")]], F.col("category"), F.col("event_type")).agg(
        F.grouping_id().alias("_set"), F.sum("_rows").alias("events"), F.countDistinct("user_id").alias("users"), combined_total().alias("amount")
    )
    # Bits of the columns that are left out: both, the event type, the category.
    section = F.when(F.col("_set") == 3, "total").when(F.col("_set") == 1, "category").otherwise("event_type")
    item = F.when(F.col("_set") == 3, "all").when(F.col("_set") == 1, F.col("category")).otherwise(F.col("event_type"))
    told = sets.select(section.alias("section"), item.alias("item"), "events", "users", "amount")
    # One row per category, event type and in total: little to order.
    turn = Window.partitionBy("section").orderBy(F.desc("events"), "item")
    placed = told.withColumn("_n", F.row_number().over(turn))
    return placed.filter((F.col("section") != "category") | (F.col("_n") <= busiest)).drop("_n")


