"""Plans, and hot keys: one key holds a third of all rows and must not end up in one task."""

from __future__ import annotations

import math
import random
import re
import statistics

import pytest
from conftest import SMALL
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.functions.times import time_slice
from sluice.functions.values import money
from sluice.operators import aggregates, joins, metrics, ordered, project, sessions, windows
from sluice.plans import analytics, log_reports
from sluice.queries import relational
from sluice.queries.catalog import QUERIES
from sluice.sources import tables as t
from sluice.streaming import windows as stream_windows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def hot(spark):
    """Events of 30 users, where user 0 holds a third of the rows, many at the same time."""
    rnd = random.Random(3)
    kinds = ["view", "click", "purchase", "error"]
    rows = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else rnd.randrange(30)
        second = rnd.randrange(0, 20 * 86400, 7 if user else 600)
        rows.append((i, user, rnd.choice(kinds), second, rnd.randrange(1, 40000) / 100))
    df = spark.createDataFrame(rows, "event_id BIGINT, user_id BIGINT, event_type STRING, s BIGINT, amount DOUBLE")
    return df.withColumn("timestamp", F.timestamp_seconds(F.col("s") + 1704067200)).drop("s").cache()


@pytest.mark.parametrize("width", [600, 86400, 10**9])
def test_scan_equals_window_for_any_slice_width(hot, width):
    got = ordered.ordered_scan(
        hot, ["user_id"], ["timestamp", "event_id"], ordered_slice(width),
        sums={"pos": F.lit(1), "run": money("amount")},
        previous={"before": "event_type"}, following={"after": "event_type"},
    )
    w = Window.partitionBy("user_id").orderBy("timestamp", "event_id")
    want = hot.withColumns(
        {
            "pos": F.row_number().over(w).cast("bigint"),
            "run": F.sum(money("amount")).over(w.rowsBetween(Window.unboundedPreceding, 0)),
            "before": F.lag("event_type").over(w),
            "after": F.lead("event_type").over(w),
        }
    )
    assert same(got, want)


def ordered_slice(width):
    return time_slice("timestamp", width)


def test_scan_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (5, 1), (5, None)], "k INT, o INT")
    got = ordered.ordered_scan(df, ["k"], ["o"], F.col("o"), sums={"pos": F.lit(1)})
    w = Window.partitionBy("k").orderBy("o")
    assert same(got, df.withColumn("pos", F.row_number().over(w).cast("bigint")))


def sizes_of(df, keys, by, tie, rows):
    flagged, slices = ordered.hot_slices(df, keys, by, tie, slice_rows=rows)
    at = F.lit(0) if slices is None else slices
    return [r["count"] for r in flagged.groupBy(*keys, at.alias("slice")).count().collect()]


def test_a_stray_row_does_not_widen_the_slices(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id", (F.col("id") * 60 + 1_700_000_000).alias("at"))
    stray = df.union(spark.createDataFrame([(1, 5000, 0)], "k INT, id BIGINT, at BIGINT"))
    assert max(sizes_of(stray, ["k"], "at", "id", 10)) <= 40 and len(sizes_of(stray, ["k"], "at", "id", 10)) >= 50


def test_a_burst_is_cut_by_the_tie(spark):
    burst = spark.range(1000).select(F.lit(1).alias("k"), "id", F.when(F.col("id") < 900, 7).otherwise(F.col("id")).alias("at"))
    assert max(sizes_of(burst, ["k"], "at", "id", 50)) <= 150


def test_even_keys_are_not_cut(spark):
    even = spark.range(10_000).select((F.col("id") % 100).alias("k"), "id", F.col("id").alias("at"))
    assert sizes_of(even, ["k"], "at", "id", 200) == [100] * 100


def test_only_hot_keys_are_cut(spark):
    mixed = spark.range(3000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 50).alias("k"), "id", F.col("id").alias("at"))
    sizes = sizes_of(mixed, ["k"], "at", "id", 100)
    assert len(sizes) >= 50 + 8 and max(sizes) <= 250


@pytest.mark.parametrize("rows", [5, 60, 10**6])
def test_sequences_for_any_slice_size(hot, rows):
    from sluice.operators.windows import user_sequence

    got = user_sequence(hot, slice_rows=rows).select("event_id", "event_sequence", "previous_event")
    w = Window.partitionBy("user_id").orderBy("timestamp", "event_id")
    want = hot.select(
        "event_id", F.row_number().over(w).cast("bigint").alias("event_sequence"), F.lag("event_type").over(w).alias("previous_event")
    )
    assert same(got, want)


def test_many_edges(spark):
    edges = [float(i) for i in range(0, 1000, 3)]
    df = spark.range(-5, 1010).select(F.col("id").cast("double").alias("v"))
    want = F.greatest(F.lit(0), F.least(F.lit(len(edges)), F.floor(F.col("v") / 3) + 1))
    assert df.filter(ordered._bucket(F.col("v"), edges) != want).count() == 0


@pytest.mark.parametrize("rows", [7, 200, 10**6])
def test_moving_sums_equal_range_frame(spark, hot, rows):
    us = F.unix_micros("timestamp")
    df = hot.select("event_id", "user_id", "amount", us.alias("us"))
    got = ordered.moving_sums(df, ["user_id"], "us", 3600_000_000, {"n": F.lit(1), "s": money("amount")}, rows)
    w = Window.partitionBy("user_id").orderBy("us").rangeBetween(-3600_000_000, 0)
    want = df.withColumns({"n": F.count(F.lit(1)).over(w), "s": F.sum(money("amount")).over(w)})
    assert same(got, want)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from([0, 0, 0, 1, 2, 3, 7, -4, None]), min_size=1, max_size=40), st.booleans(), st.integers(2, 9))
def test_ranks_with_heavy_ties(spark, numbers, descending, parts):
    df = spark.createDataFrame(list(enumerate(numbers)), "id BIGINT, v INT")
    order = F.desc_nulls_last("v") if descending else F.asc_nulls_first("v")
    got = ordered.row_numbers(df, "v", ["id"], descending, parts)
    assert same(got, df.withColumn("position", F.row_number().over(Window.orderBy(order, "id")).cast("bigint")))
    w = Window.orderBy(order)
    want = df.select(
        "v", F.rank().over(w).cast("bigint").alias("rank"), F.dense_rank().over(w).cast("bigint").alias("dense_rank"),
        F.percent_rank().over(w).alias("percent_rank"),
    ).distinct()
    assert same(ordered.value_ranks(df, "v", descending, parts), want)


@pytest.mark.parametrize("rows", [10, 200, 10**6])
def test_sessions_equal_session_window(hot, rows):
    got = sessions.sessions(hot, "user_id", "timestamp", "amount", "event_type", slice_rows=rows)
    assert same(got, stream_windows.sessions(hot))


@pytest.mark.parametrize("segment", [1, 3, 1000])
def test_paths_convert_across_segments(hot, segment):
    raw = hot.withColumn("session_id", F.col("user_id").cast("string"))
    got = sessions.behavior_paths(raw, minutes=60 * 24, segment=segment)
    w = F.window("timestamp", "1 day").start
    entry = F.sort_array(F.collect_list(F.struct("timestamp", "event_id", "event_type")))
    want = raw.groupBy("session_id", "user_id", w.alias("window_start")).agg(
        F.array_join(F.transform(entry, lambda e: e["event_type"]), " -> ").alias("path")
    )
    flags = got.select("session_id", "user_id", "window_start", "converted").distinct()
    assert same(
        flags,
        want.select("session_id", "user_id", "window_start", F.col("path").like("%view%click%purchase%").alias("converted")),
    )
    joined = got.groupBy("session_id", "user_id", "window_start").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("segment", "event_sequence"))), lambda s: s["event_sequence"]), " -> ").alias("path")
    )
    assert same(joined, want)


def test_hot_key_is_spread(hot):
    """The largest share of rows one (key, slice) holds follows the slice, not the key."""
    sliced = hot.groupBy("user_id", ordered_slice(86400)).count()
    assert sliced.agg(F.max("count")).first()[0] < hot.filter("user_id = 0").count() / 10
    numbered = ordered.ordered_scan(hot, ["user_id"], ["timestamp"], ordered_slice(86400), sums={"n": F.lit(1)})
    assert "hashpartitioning(user_id" in plan(numbered) and "_slice" in plan(numbered)


def test_hot_side_is_salted(hot, spark):
    other = spark.range(30).select(F.col("id").alias("user_id"), F.col("id").alias("name"))
    joined = joins.salted_join(hot, other, "user_id", "event_id", share=0.1, parts=8)
    assert joined.count() == hot.count()


@pytest.mark.parametrize("how", ["inner", "left"])
def test_co_partitioned_join(hot, spark, how):
    other = spark.range(5, 40).select(F.col("id").alias("user_id"), F.col("id").alias("name"))
    got = joins.co_partitioned_join(hot, other, "user_id", "event_id", how, share=0.1, parts=8)
    assert same(got, hot.join(other, "user_id", how))


def test_keep_all_equals_outer_join(hot, spark):
    other = spark.range(-3, 40).select(F.when(F.col("id") >= 0, F.col("id")).alias("user_id"), F.col("id").alias("name"))
    assert same(joins.keep_all(other, hot, "user_id"), other.join(hot, "user_id", "left"))


def test_one_row_per_key_is_limited_before_the_shuffle(spark):
    raw = t.table(spark, SMALL, "events").select("user_id", "event_id")
    assert plan(project.first_per_key(raw, ["user_id"], ["event_id"])).count("WindowGroupLimit") == 2
    assert plan(QUERIES["topn_group"](spark, SMALL)).count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_in"](spark, SMALL))
    assert "PushedFilters: [In(event_type" in text and "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string>" in text
    text = plan(QUERIES["filter_between"](spark, SMALL))
    assert "GreaterThanOrEqual(ts" in text and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text
    assert "ReadSchema: struct<user_id:bigint>" in plan(QUERIES["agg_having"](spark, SMALL))


def test_groups_are_aggregated_before_the_shuffle(spark):
    text = plan(QUERIES["biz_hourly"](spark, SMALL))
    assert "partial_sum" in text and text.index("partial_sum") > text.index("Exchange")


def test_top_list_is_no_global_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top_ips"](spark, SMALL))


def test_band_join_is_hashed(spark):
    text = plan(QUERIES["join_range"](spark, SMALL))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_query_multiplies_tables(spark, key):
    if key in ("path_partitions", "pruned_scan", "codec_sizes", "format_report", "run_metadata") or QUERIES[key].__module__.endswith("deliveries"):
        pytest.skip("writes files; its plan is a scan")
    text = plan(QUERIES[key](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_flagship(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0


def test_cohort_by_day(hot):
    out = analytics.purchase_cohorts(hot)
    assert out.filter("days_since_first < 0 AND active_users <= 0").count() == 0
    assert dict(out.dtypes)["first_purchase_date"] == "date"


ODD_AMOUNTS = [1.0, 1e25, 0.0004, 0.0006, None, 123456.789, 1.0, 1.0]


@pytest.fixture
def odd(spark):
    """Amounts that do not fit the exact type, with more decimals than two, and none, in one user's hour."""
    at = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("n").cast("decimal(18,6)"))
    rows = [(n, v) for n, v in enumerate(ODD_AMOUNTS)]
    return spark.createDataFrame(rows, "n INT, amount DOUBLE").select(
        F.col("n").cast("bigint").alias("event_id"), F.lit(1).cast("bigint").alias("user_id"), F.lit("s").alias("session_id"),
        F.lit("view").alias("event_type"), F.lit("books").alias("category"), at.alias("timestamp"), "amount",
    )


def test_amounts_that_do_not_fit_are_summed_as_doubles(spark, odd):
    want = sum(v for v in ODD_AMOUNTS if v is not None)
    assert sessions.sessions(odd, "user_id", "timestamp", "amount", "event_type").first()["total_value"] == pytest.approx(want)
    assert sessions.behavior_paths(odd, segment=3).first()["total_value"] == pytest.approx(want)
    ran = windows.running(odd, ["user_id"], "timestamp", "amount").orderBy("timestamp").collect()
    assert [r["running_total"] for r in ran] == pytest.approx([1.0] + [1e25] * 7)
    assert ran[-1]["running_mean"] == pytest.approx(want / 7)
    trends = windows.daily_trends(odd, "category", "timestamp", "amount").first()
    assert trends["daily_revenue"] == trends["revenue_ma"] == pytest.approx(want)
    assert windows.hourly_trend(odd, "timestamp", "amount").first()["revenue"] == pytest.approx(want)


@pytest.mark.parametrize("slice_rows", [3, 10**6])
def test_moving_statistics_of_odd_amounts(spark, odd, slice_rows):
    later = odd.filter("event_id >= 2").withColumns({"timestamp": F.col("timestamp") + F.expr("INTERVAL 3 HOURS"), "event_id": F.col("event_id") + 100})
    got = ordered.moving_statistics(odd.union(later), ["user_id"], "timestamp", "amount", 3600, slice_rows).orderBy("event_id").collect()
    def expected(values):
        known = [v for v in values if v is not None]
        return len(known), sum(known) / len(known), statistics.stdev(known) if len(known) > 1 else None
    for n, r in enumerate(got[:8]):
        count, mean, deviation = expected(ODD_AMOUNTS[: n + 1])
        assert (r["moving_count"], r["moving_mean"], r["moving_stddev"]) == (count, pytest.approx(mean), deviation if deviation is None else pytest.approx(deviation))
    for n, r in enumerate(got[8:]):
        count, mean, deviation = expected(ODD_AMOUNTS[2 : n + 3])
        assert (r["moving_count"], r["moving_mean"]) == (count, pytest.approx(mean))
        assert r["moving_stddev"] == (deviation if deviation is None else pytest.approx(deviation, rel=1e-6))


def test_frames_with_what_is_no_number(spark, odd):
    bad = odd.withColumn("amount", F.when(F.col("event_id") == 1, F.lit(float("nan"))).otherwise(F.col("amount")))
    got = ordered.moving_statistics(bad, ["user_id"], "timestamp", "amount", 0).orderBy("event_id").collect()
    assert [r["moving_mean"] is not None and math.isnan(r["moving_mean"]) for r in got] == [False, True] + [False] * 6


def scans(df, table):
    """Scans of a table that a query ran: those in final plans, where an exchange that is used again stands once."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]
    return len(re.findall(rf"ColumnarToRow\n[^\n]*FileScan parquet[^\n]*{table}\.parquet", text))


def test_few_scans_and_no_jobs_while_a_query_is_built(spark):
    users, events_ = t.users(spark, SMALL), t.events(spark, SMALL)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    outer = joins.keep_all(users.select("user_id", "name"), events_.select("user_id", "event_id"), "user_id")
    salted = joins.salted_join(events_.select("user_id", "event_id"), users.select("user_id", "name"), "user_id", "event_id")
    live = analytics.live_metrics(events_, F.lit("2024-01-30").cast("date"))
    assert not list(tracker.getJobIdsForGroup("building"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    paths = sessions.behavior_paths(events_)  # counts its keys first
    assert (scans(outer, "events"), scans(salted, "events"), scans(live, "events"), scans(paths, "events")) == (2, 2, 1, 1)


def test_users_are_scored_from_two_scans(spark):
    assert scans(analytics.rfm(t.events(spark, SMALL)), "events") <= 2


def test_rfm_cut_in_slices_equals_rfm_in_one(spark):
    whole = analytics.rfm(t.events(spark, SMALL))
    cut = analytics.rfm(t.events(spark, SMALL), slice_rows=20)
    assert same(whole, cut)


def test_log_points_by_pattern(spark):
    rows = [("2024-01-01 10:00:05", "ERROR code 7"), ("2024-01-01 10:00:59", "ERROR code x"), ("2024-01-01 10:01:00", "ok code 5 ERROR"), (None, "ERROR"), ("2024-01-01 10:01:01", None)]
    logs = spark.createDataFrame(rows, "at STRING, line STRING").withColumn("at", F.col("at").cast("timestamp_ntz"))
    got = metrics.pattern_points(logs, "L", "at", "line", {"Errors": "ERROR", "Codes": "code ([0-9]+)", "None": "never"})
    assert sorted((r["metric"], r["at"].minute, r["value"], r["unit"]) for r in got.collect()) == [
        ("Codes", 0, 7.0, "None"), ("Codes", 1, 5.0, "None"), ("Errors", 0, 2.0, "Count"), ("Errors", 1, 1.0, "Count"),
    ]


def test_steps_are_met_within_names_as_like_has_it(spark):
    names = [["review", "xclickpurchase"], ["view", "purchase", "click"], ["viewclickpurchase"], ["clickview", "click-purchase"], ["view", None, "click", "purchase"]]
    rows = [(n, i, str(n), v) for n, list_ in enumerate(names) for i, v in enumerate(list_)]
    base = spark.createDataFrame(rows, "user_id BIGINT, event_id BIGINT, session_id STRING, event_type STRING")
    events_ = base.withColumns({"timestamp": F.lit("2024-01-01").cast("timestamp_ntz"), "amount": F.lit(1.0)})
    for segment in (1, 2, 1000):
        got = {r["user_id"]: r["converted"] for r in sessions.behavior_paths(events_, segment=segment).collect()}
        assert got == {0: True, 1: False, 2: True, 3: True, 4: True}


def test_reports_of_several_tables_read_the_rows_twice_at_most(spark):
    rows = t.events(spark, SMALL)
    reports = analytics.dashboard(rows), log_reports.summary_of_reports(rows), metrics.capacity_report(rows, "timestamp", F.col("response_size"), "user_id")
    assert [scans(r, "events") <= 2 for r in reports] == [True] * 3


def lower_quantile(values, share):
    known = sorted(v for v in values if v is not None)
    return known[max(1, math.ceil(len(known) * share)) - 1] if known else None


def test_medians_and_quartiles_of_many_values_are_exact(spark):
    draw = random.Random(3)
    rows = [(i % 7, draw.choice(["a", None]), "t", draw.choice([None, 5.0, draw.lognormvariate(3, 1), draw.lognormvariate(3, 1)])) for i in range(100_000)]
    rows += [(1, "none", "t", None), (1, "one", "t", -1.0), (1, "nan", "t", math.inf), (1, "nan", "t", -0.5), (1, "nan", "t", math.inf)]
    table = spark.createDataFrame(rows, "user_id BIGINT, category STRING, event_type STRING, amount DOUBLE")
    groups = {c: [r[3] for r in rows if r[1] == c] for c in ("a", None, "none", "one", "nan")}
    medians = {c: lower_quantile(v, 0.5) for c, v in groups.items()}
    assert {r["category"]: r["median_amount"] for r in analytics.business_summary(table).collect()} == medians
    want = {c: tuple(lower_quantile(v, p) for p in (0.25, 0.5, 0.75)) for c, v in groups.items()}
    both = aggregates.quartiles(table.withColumn("neg", -F.col("amount")), ["amount", "neg"], ["category"]).collect()
    assert {r["category"]: (r["amount_q1"], r["amount_median"], r["amount_q3"]) for r in both} == want
    assert {r["category"]: r["neg_median"] for r in both} == {c: lower_quantile([None if x is None else -x for x in v], 0.5) for c, v in groups.items()}
    whole = aggregates.quartiles(table, ["amount", "user_id"]).collect()
    assert [(r["amount_q3"], r["user_id_median"]) for r in whole] == [(lower_quantile([r[3] for r in rows], 0.75), 3)]
    none = table.filter("user_id < 0")
    assert [tuple(r) for r in aggregates.quartiles(none, ["amount"]).collect()] == [(None, None, None)]
    assert not aggregates.quartiles(none, ["amount"], ["category"]).collect() and not analytics.business_summary(none).collect()
    cut = ordered.quantiles(table, ["category"], "amount", {"q1": 0.25, "q2": 0.5, "q3": 0.75}, slice_rows=9000)
    assert {r["category"]: tuple(r)[1:] for r in cut.collect()} == want


def test_lines_are_grouped_apart_from_their_join(spark):
    users = spark.range(40).selectExpr("id AS user_id", "concat('u', id) AS name")
    orders = spark.range(3000).selectExpr("id AS order_id", "IF(id % 3 = 0, 0, id % 40) AS user_id", "CAST(id % 7 AS DECIMAL(18,2)) AS amount")
    details = spark.range(9000).selectExpr("id DIV 3 AS order_id", "id % 3 AS line", "IF(id % 3 = 0, 0, id % 50) AS product_id", "1.0D AS quantity")
    products = spark.range(50).selectExpr("id AS product_id", "concat('p', id) AS name", "'c' AS category")
    lines = joins.order_lines(users, orders, details, products)
    raw = lines.collect()
    for make in (joins.purchases_per_user, joins.purchases_per_user_once, joins.purchased_products):
        # The join's stage ends where the lines are dealt out; grouping starts in the next one.
        assert re.search(r"(?s)HashAggregate.*Exchange hashpartitioning\(order_id#\d+L?, product_id#\d+L?, 5\), REPARTITION_BY_NUM.*Join", plan(make(lines, parts=5)))
        assert same(make(lines, parts=5), make(lines))
    got = {r["user_id"]: (r["total_orders"], r["total_spent"], r["unique_products"]) for r in joins.purchases_per_user(lines, parts=5).collect()}
    mine = {u: [r for r in raw if r["user_id"] == u] for u in range(40)}
    assert got == {u: (len(m), float(sum(r["amount"] for r in m)), len({r["product_id"] for r in m})) for u, m in mine.items()}
    pieces = lines.repartition(5, "order_id", "product_id").rdd.glom().map(len).collect()
    assert max(pieces) < 9000 / 3  # user 0 and product 0 hold a third each


def test_lines_are_dealt_out_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(relational.t, "order_details", lambda spark, folder: spark.range(20_000_000))
    assert relational.line_parts(spark, "") == max(spark.sparkContext.defaultParallelism, 40)
