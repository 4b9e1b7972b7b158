"""Small inputs with results worked out by hand."""

from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.functions import text, times, values
from sluice.operators import aggregates, joins, layout, logs, metrics, ordered, project, quality, windows
from sluice.plans import analytics


@pytest.fixture(scope="module")
def shop(spark):
    """Users without orders or age, orders without a (known) user, lines without an order."""
    users = spark.createDataFrame(
        [
            (11, "Ines", "ines@mail.test", 19), (12, "Joel", "joel@post.test", 33), (13, "Kofi", "kofi@mail.test", 58),
            (14, "Lena", None, 40), (15, "Mara", "mara@web.test", None),
        ],
        "user_id BIGINT, name STRING, email STRING, age INT",
    )
    orders = spark.createDataFrame(
        [
            (901, 12, 20.5, "2023-05-01"), (902, 12, 9.25, "2023-05-03"), (903, 13, 70.0, "2023-05-03"),
            (904, 11, 5.0, "2023-05-04"), (905, 77, 31.0, "2023-05-05"), (906, None, 8.0, "2023-05-06"),
        ],
        "order_id BIGINT, user_id BIGINT, amount DOUBLE, order_date STRING",
    )
    products = spark.createDataFrame(
        [(31, "Lamp", "home", 12.0), (32, "Rope", "sport", 3.5), (33, "Tea", "food", 4.25), (34, "Vase", "home", 15.0)],
        "product_id BIGINT, name STRING, category STRING, price DOUBLE",
    )
    details = spark.createDataFrame(
        [(901, 31, 1), (901, 32, 2), (902, 33, 1), (903, 31, 3), (905, 34, 1), (999, 33, 1)],
        "order_id BIGINT, product_id BIGINT, quantity INT",
    )
    return users, orders, products, details


@pytest.fixture(scope="module")
def sales(spark):
    """Four sellers over three months, with a tie."""
    rows = [
        ("Nils", "East", "2023-04", 310), ("Nils", "East", "2023-05", 290), ("Nils", "East", "2023-06", 350),
        ("Oona", "West", "2023-04", 500), ("Oona", "West", "2023-05", 500), ("Oona", "West", "2023-06", 420),
        ("Pia", "East", "2023-04", 610), ("Pia", "East", "2023-05", 580), ("Pia", "East", "2023-06", 640),
        ("Rui", "West", "2023-04", 275), ("Rui", "West", "2023-05", 330), ("Rui", "West", "2023-06", 300),
    ]
    return spark.createDataFrame(rows, "salesperson STRING, region STRING, month STRING, sales BIGINT")


@pytest.fixture(scope="module")
def stock(spark):
    rows = [
        ("ABX", dt.date(2023, 3, 1), 20.0), ("ABX", dt.date(2023, 3, 2), 22.0), ("ABX", dt.date(2023, 3, 6), 21.0),
        ("QLM", dt.date(2023, 3, 1), 310.0), ("QLM", dt.date(2023, 3, 2), 300.0), ("QLM", dt.date(2023, 3, 3), 330.0),
        ("QLM", dt.date(2023, 3, 6), 320.0), ("QLM", dt.date(2023, 3, 7), 340.0), ("QLM", dt.date(2023, 3, 8), 360.0),
    ]
    return spark.createDataFrame(rows, "symbol STRING, date DATE, price DOUBLE")


@pytest.fixture(scope="module")
def clicks(spark):
    rows = [
        (51, 7, "visit", "2023-03-01 08:00:00", 0.0), (52, 7, "search", "2023-03-01 08:03:00", 0.0),
        (53, 7, "pay", "2023-03-01 08:20:00", 12.5), (54, 8, "visit", "2023-03-01 09:00:00", 0.0),
        (55, 8, "search", "2023-03-01 09:04:00", 0.0), (56, 9, "visit", "2023-03-01 10:00:00", 0.0),
        (57, 9, "pay", "2023-03-01 10:05:00", 40.0), (58, 7, "visit", "2023-03-02 07:00:00", 0.0),
        (59, 10, "visit", "2023-03-02 07:30:00", 0.0),
    ]
    raw = spark.createDataFrame(rows, "event_id BIGINT, user_id BIGINT, event_type STRING, t STRING, amount DOUBLE")
    return raw.withColumn("timestamp", F.to_timestamp("t")).drop("t")


def names(df, column="name"):
    return sorted(str(r[0]) for r in df.select(column).collect())


@pytest.mark.parametrize(
    ("how", "expected"), [("inner", 4), ("left", 6), ("right", 6), ("full", 8), ("left_semi", 3), ("left_anti", 2)]
)
def test_joins(shop, how, expected):
    users, orders, *_ = shop
    assert users.join(orders, "user_id", how).count() == expected


def test_semi_and_anti_name_the_users(shop):
    users, orders, *_ = shop
    assert names(users.join(orders, "user_id", "left_semi")) == ["Ines", "Joel", "Kofi"]
    assert names(users.join(orders, "user_id", "left_anti")) == ["Lena", "Mara"]
    assert names(joins.orphans(orders, users, "user_id", "user_id"), "order_id") == ["905", "906"]


@pytest.mark.parametrize("lookup", ["cells", "broadcast", "too large to broadcast"])
def test_age_bands(spark, shop, lookup):
    bands = spark.sql("SELECT * FROM VALUES ('young',0,25),('middle',26,45),('older',46,99) b(age_group,low,high)")
    users = shop[0]
    if lookup == "cells":
        found = joins.band_lookup(users, "age", bands, "low", "high", 15)
    else:
        limit = layout.MB if lookup == "broadcast" else 0
        found = joins.band_lookup_broadcast(users, "age", bands, "low", "high", 15, limit)
    got = {r["name"]: r["age_group"] for r in found.collect()}
    assert got == {"Ines": "young", "Joel": "middle", "Kofi": "older", "Lena": "middle"}


def test_order_lines_and_summaries(shop):
    users, orders, products, details = shop
    lines = joins.order_lines(users, orders, details, products)
    assert lines.count() == 4
    repeated = {r["user_name"]: (r["total_orders"], r["total_spent"]) for r in joins.purchases_per_user(lines).collect()}
    assert repeated == {"Joel": (3, 50.25), "Kofi": (1, 70.0)}
    once = {r["user_name"]: (r["total_orders"], r["total_spent"]) for r in joins.purchases_per_user_once(lines).collect()}
    assert once == {"Joel": (2, 29.75), "Kofi": (1, 70.0)}
    assert {r["user_name"]: r["unique_products"] for r in joins.purchases_per_user_once(lines).collect()} == {"Joel": 3, "Kofi": 1}
    assert joins.purchased_products(lines).count() == 4


def test_summary_of_a_user_lists_the_products(spark):
    line = "user_id BIGINT, user_name STRING, order_id BIGINT, amount DECIMAL(18,2), product_id BIGINT, product_name STRING"
    rows = [(1, "Ana", 10, 5, 7, "pen"), (1, "Ana", 10, 5, 8, "ink"), (1, "Ana", 11, 2, 7, "pen"), (1, "Ana", 11, 2, 9, None), (2, None, 12, None, 7, "nib"), (2, None, None, 1, 7, "pen")]
    lines = spark.createDataFrame([(u, n, o, None if a is None else Decimal(a), p, name) for u, n, o, a, p, name in rows], line)
    got = {r["user_id"]: tuple(r)[1:] for r in joins.purchases_per_user(lines).collect()}
    assert got == {1: ("Ana", 4, 14.0, 3, ["ink", "pen", "pen"]), 2: (None, 1, 1.0, 1, ["nib", "pen"])}
    unnamed = joins.purchases_per_user(lines.where("product_name IS NULL")).collect()
    assert [r["purchased_products"] for r in unnamed] == [[]]


def test_salted_join_equals_plain_join(spark):
    big = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("k")
    )
    small = spark.range(30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = joins.salted_join(big, small, "k", "id", how, share=0.05, parts=5)
        want = big.join(small, "k", how).select(*got.columns)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0, how


def test_fan_out(shop):
    _, orders, _, details = shop
    got = {r["order_id"]: r["output_rows"] for r in joins.fan_out(orders, details, "order_id").collect()}
    assert got == {901: 2, 902: 1, 903: 1, 905: 1}


def test_group_values_with_few_and_many_groups(spark):
    df = spark.range(100).select("id", (F.col("id") % 10).alias("g"))
    means = df.groupBy("g").agg(F.avg("id").alias("mean"))
    few, many = joins.with_group_values(df, ["g"], means), joins.with_group_values(df, ["g"], means, most=3)
    assert few.exceptAll(many).count() == 0 and few.count() == 100


def test_sales_windows(sales):
    first = ordered.row_numbers(sales, "sales", ["salesperson", "month"], descending=True).filter("position = 1").first()
    assert (first["salesperson"], first["month"], first["sales"]) == ("Pia", "2023-06", 640)
    moving = windows.moving_mean(sales, ["salesperson"], "month", "sales", 3, "ma")
    assert moving.filter("salesperson = 'Pia' AND month = '2023-06'").first()["ma"] == 610.0
    totals = {r["region"]: r["group_total"] for r in windows.contribution(sales, "region", "sales").collect()}
    assert totals == {"East": 2780.0, "West": 2325.0}
    near = windows.neighbours(sales, ["salesperson"], "month", "sales")
    row = near.filter("salesperson = 'Rui' AND month = '2023-05'").first()
    assert (row["previous"], row["next"], row["first"], row["last_so_far"], row["last_of_all"]) == (275, 300, 275, 330, 300)
    assert row["growth_percent"] == 20.0


def test_stock_windows(stock):
    change = windows.changes(stock, ["symbol"], "date", "price").filter("symbol = 'ABX' AND date = '2023-03-02'").first()
    assert change["change"] == 2.0 and change["change_percent"] == 10.0
    five = windows.volatility(stock, ["symbol"], "date", "price").filter("symbol = 'QLM' AND date = '2023-03-08'").first()
    assert five["moving_mean"] == 330.0 and (five["moving_min"], five["moving_max"]) == (300.0, 360.0)


def test_transitions(clicks):
    got = {r["event_pair"]: r["count"] for r in analytics.transitions(clicks).collect()}
    assert got == {"visit->search": 2, "search->pay": 1, "pay->visit": 1, "visit->pay": 1}


def test_funnel_and_first_rows(clicks):
    got = [tuple(r) for r in analytics.funnel(clicks, ["visit", "search", "pay"]).collect()]
    assert got == [(1, "visit", 4, 100.0), (2, "search", 2, 50.0), (3, "pay", 2, 50.0)]
    assert names(project.first_per_key(clicks, ["user_id"], ["timestamp"]), "event_id") == ["51", "54", "56", "59"]


APACHE = (
    '10.8.0.7 - - [03/Feb/2023:04:05:06 +0100] "PUT /carts/9?x=1 HTTP/2" 201 77 '
    '"https://shop.test/" "Agent/1.0 (X; Y)"'
)


def test_access_lines(spark):
    lines = spark.createDataFrame(
        [(APACHE,), ('::1 - eve [03/Feb/2023:04:05:07 +0000] "POST /x HTTP/1.1" 404 - "-" "curl"',), ("no log line",)],
        "line STRING",
    )
    a, b = logs.parse_apache(lines).orderBy("status_code").collect()
    assert a["timestamp"] == dt.datetime(2023, 2, 3, 3, 5, 6)
    assert (a["ip_address"], a["method"], a["path"], a["protocol"]) == ("10.8.0.7", "PUT", "/carts/9?x=1", "HTTP/2")
    assert (a["status_code"], a["response_size"], a["referer"], a["user_agent"]) == (201, 77, "https://shop.test/", "Agent/1.0 (X; Y)")
    assert (b["status_code"], b["response_size"], b["referer"]) == (404, 0, None)
    assert logs.parse_nginx(lines).count() == 1


def test_application_lines(spark):
    lines = spark.createDataFrame(
        [
            ('{"timestamp": "2024-05-26T10:30:45Z", "message": "in", "user_id": 7, "order_id": 3}',),
            ('{"level": "WARN", "logger": "db"}',), ("plain words",), ("123",),
        ],
        "line STRING",
    )
    rows = logs.parse_application(lines, received_at=F.lit("2024-06-01").cast("timestamp")).collect()
    got = {(r["level"], r["message"], r["logger"], r["user_id"], r["log_type"]) for r in rows}
    assert got == {
        ("INFO", "in", "unknown", "7", "application"), ("WARN", "", "db", None, "application"),
        ("INFO", "plain words", None, None, "application_text"), ("INFO", "123", None, None, "application_text"),
    }
    assert sum(r["timestamp"] == dt.datetime(2024, 6, 1) for r in rows) == 3


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_status_classes(spark):
    codes = [200, 301, 404, 500, 0, None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(codes)], "i INT, code INT").orderBy("i")
    got = [r[0] for r in df.select(quality.status_class("code")).collect()]
    assert got == ["Success", "Other", "Client Error", "Server Error", None, None]


def test_addresses(spark):
    got = one(
        spark,
        a=text.mask_ip(F.lit("172.20.3.44")), b=text.mask_ip(F.lit("::1")),
        c=text.mask_ip(F.lit(None).cast("string")), d=text.mask_ip(F.lit("")),
        n=text.ip_number(F.lit("10.0.1.2")), bad=text.ip_number(F.lit("10.0.1.256")), word=text.ip_number(F.lit("a.b.c.d")),
    )
    assert tuple(got) == ("172.20.3.xxx", "anonymized", None, None, 10 * 2**24 + 258, None, None)


def test_personal_data(spark):
    got = one(spark, t=text.mask_personal_data(F.lit("write a.b@c.org or +1 (555) 123-4567 from 10.0.0.1 now")))
    assert got["t"] == "write [EMAIL] or [PHONE] from [IP] now"


@pytest.mark.parametrize(
    "number", ["444-221-9087", "(444) 221-9087", "030-2214-9087", "+49-30-2214-9087", "+1 444 221 9087", "444.221.9087"]
)
def test_written_forms_of_phone_numbers(spark, number):
    assert one(spark, t=text.mask_personal_data(F.lit(f"call {number} or 12345678 today")))["t"] == "call [PHONE] or 12345678 today"


@pytest.mark.parametrize("word", ["2024", "2024-01", "2024-01-02", "10:00:00", "T10:00", "2024-13-01T00:00:00", "now", "", "2024-01-02T10"])
def test_times_that_are_not_whole(spark, word):
    assert one(spark, t=times.parse_iso(F.lit(word)))["t"] is None


def test_whole_times(spark):
    rows = spark.createDataFrame([("2024-01-02T10:00:00Z",), ("2024-01-02 12:00:00+02:00",), ("2024-01-02T10:00:00.000",)], "t STRING")
    assert {r[0] for r in rows.select(times.parse_iso("t")).collect()} == {dt.datetime(2024, 1, 2, 10)}


def test_amounts_keep_their_digits(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (None,)], "x DOUBLE")
    assert tuple(df.agg(values.total("x"), values.mean("x")).first()) == (0.008, 0.004)
    huge = spark.createDataFrame([(1e25,), (1e25,), (0.5,)], "x DOUBLE")
    assert huge.agg(values.total("x")).first()[0] == 2e25
    assert aggregates.group_profile(df.withColumn("g", F.lit("a")), ["g"]).first()["x_sum"] == 0.008


def test_rows_without_a_value_keep_their_rank(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 9), (4, 5), (5, None)], "id BIGINT, v INT")
    down = {r["id"]: r["position"] for r in ordered.row_numbers(df, "v", ["id"], descending=True).collect()}
    assert down == {3: 1, 1: 2, 4: 3, 2: 4, 5: 5}
    ranked = ordered.with_ranks(df, ordered.value_ranks(df, "v", descending=True), "v")
    assert {r["id"]: (r["rank"], r["dense_rank"]) for r in ranked.collect()} == {3: (1, 1), 1: (2, 2), 4: (2, 2), 2: (4, 3), 5: (4, 3)}
    up = {r["id"]: r["position"] for r in ordered.row_numbers(df, "v", ["id"]).collect()}
    assert up == {2: 1, 5: 2, 1: 3, 4: 4, 3: 5}


def test_quoted_fields_come_back_whole(spark, folder):
    from sluice.sources import readers

    value = '{"k": 7, "m": "a,b"}'
    spark.createDataFrame([(1, value)], "i INT, v STRING").write.options(**readers.CSV).csv(f"{folder}/quoted")
    assert readers.read_csv(spark, f"{folder}/quoted", "i INT, v STRING").first()["v"] == value


def test_alarms_keep_dimensions_and_gaps_apart(spark):
    at = lambda m: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)
    rows = [("a", at(0), 9.0), ("b", at(0), 9.0), ("a", at(540), 9.0), ("a", at(545), 9.0), ("b", at(5), 1.0)]
    df = spark.createDataFrame([("n", "m", *r) for r in rows], "namespace STRING, metric STRING, host STRING, period_start TIMESTAMP, average DOUBLE")
    out = metrics.alarms(df, "m", "average", "GreaterThanThreshold", 5, periods=2, dimensions=["host"])
    assert {(r["host"], r["period_start"]): r["state"] for r in out.collect()} == {
        ("a", at(0)): "OK", ("b", at(0)): "OK", ("a", at(540)): "OK", ("a", at(545)): "ALARM", ("b", at(5)): "OK",
    }


@pytest.mark.parametrize(
    ("record", "valid"),
    [
        ('{"timestamp": "2024-01-01T00:00:00Z", "event_type": "x", "user_id": 5}', True),
        ('{"timestamp": "2024-01-01T00:00:00", "event_type": "x"}', True),
        ('{"timestamp": "2024-01-01T00:00:00Z", "event_type": "x", "user_id": 0}', True),
        ('{"timestamp": "2024-01-01T00:00:00Z", "event_type": "x", "user_id": null}', True),
        ('{"event_type": "x", "user_id": 5}', False),
        ('{"timestamp": "", "event_type": "x"}', False),
        ('{"timestamp": "2024-01-01T00:00:00Z", "event_type": ""}', False),
        ('{"timestamp": "2024-01-01T00:00:00Z", "event_type": 0}', False),
        ('{"timestamp": "2024-01-01T00:00:00Z"}', False),
        ('{"timestamp": "invalid-time-format", "event_type": "x"}', False),
        ('{"timestamp": "2024-01-01T00:00:00Z", "event_type": "x", "user_id": "5"}', False),
        ("not json", False),
        ("[1, 2]", False),
    ],
)
def test_record_validity(spark, record, valid):
    df = spark.createDataFrame([(record,)], "record STRING")
    assert quality.parsed(df).select(quality.is_valid()).first()[0] is valid


def test_score_of_an_empty_record(spark):
    df = quality.parsed(spark.createDataFrame([("{}",)], "record STRING"))
    assert df.select(quality.score({})).first()[0] == 61


def test_broken_json_is_a_dead_letter(spark):
    df = spark.createDataFrame([(1, "not json")], "id INT, record STRING")
    good, bad = quality.good_and_bad(df, F.lit("2024-01-01").cast("timestamp"))
    assert good.count() == 0
    assert (bad.first()["original_record"], bad.first()["error"], bad.first()["retry_count"]) == ("not json", "json:record", 0)


def test_completeness_looks_at_keys_only(spark):
    df = spark.createDataFrame([('{"timestamp": null, "event_type": null}',), ('{"timestamp": 1}',)], "record STRING")
    assert [r[0] for r in quality.parsed(df).select(quality.completeness_tag()).collect()] == ["valid", "incomplete"]


def test_partition_keys(spark):
    got = one(
        spark, a=times.partition_key(F.lit("2024-03-05T07:08:09Z")), b=times.partition_key(F.lit(None).cast("string")),
        c=times.partition_key(F.lit("soon"), "day"),
    )
    assert tuple(got) == (
        "year=2024/month=03/day=05/hour=07", "year=unknown/month=unknown/day=unknown/hour=unknown",
        "year=unknown/month=unknown/day=unknown",
    )


def test_sizes_and_capacity(spark):
    assert layout.partitions_for_size(10 * 1024) == 80 and layout.partitions_for_size(1) == 1
    assert layout.partitions_for_rows(10) == 1 and layout.partitions_for_rows(10**9) == 2000 and layout.partitions_for_rows(10**9, most=200) == 200
    assert layout.partitions_for_rows(2_600_000) == 5
    got = spark.range(1).select(*metrics.capacity(F.lit(3.5), F.lit(2500), F.lit(4))).first()
    assert (got["minimum_partitions"], got["recommended_partitions"]) == (4, 5)


def test_scale_rules(spark):
    mb = 1048576.0
    df = spark.createDataFrame([(4.0 * mb, 4), (3.3 * mb, 4), (0.5 * mb, 4), (0.1 * mb, 1), (90.0 * mb, 80), (mb, 0)], "rate DOUBLE, n INT")
    got = [(r["action"], r["target_partitions"]) for r in df.select(*metrics.scale_advice(F.col("rate"), F.col("n"))).collect()]
    assert got == [("scale_out", 8), ("scale_out", 8), ("scale_in", 2), ("hold", 1), ("scale_out", 100), ("hold", 0)]


@pytest.mark.parametrize("n", [4, 6, 7, 100])
def test_md5_buckets(spark, n):
    got = spark.range(50).select("id", metrics.md5_bucket(F.col("id").cast("string"), n).alias("b")).collect()
    assert all(r["b"] == int(hashlib.md5(str(r["id"]).encode()).hexdigest(), 16) % n for r in got)


def test_one_key_leaves_other_buckets_empty(spark):
    df = spark.range(8).select(F.lit("k").alias("k"))
    got = metrics.key_balance(df, {"same": F.col("k")}, 4).collect()
    assert sorted(r["records"] for r in got) == [0, 0, 0, 8] and round(got[0]["variation"], 4) == 173.2051


def test_alarm_needs_consecutive_periods(spark):
    rates = [70.0, 85.0, 75.0, 60.0, 79.0, 81.0]
    df = spark.createDataFrame(
        [("n", "m", dt.datetime(2024, 1, 1, 0, 5 * i), r) for i, r in enumerate(rates)],
        "namespace STRING, metric STRING, period_start TIMESTAMP, average DOUBLE",
    )
    out = metrics.alarms(df, "m", "average", "LessThanThreshold", 80, periods=2).orderBy("period_start")
    assert [r["state"] for r in out.collect()] == ["OK", "OK", "OK", "ALARM", "ALARM", "OK"]


def test_rate_levels(spark):
    df = spark.createDataFrame([(99.0,), (95.0,), (94.9,), (90.0,), (10.0,)], "r DOUBLE")
    assert [r[0] for r in df.select(metrics.rate_level("r")).collect()] == ["OK", "OK", "WARNING", "WARNING", "CRITICAL"]


def test_narrowing_checks_both_ends(spark):
    df = spark.createDataFrame([(1, 2**40, -(2**40), 1)], "a BIGINT, b BIGINT, c BIGINT, user_id BIGINT")
    assert dict(project.narrow_longs(df).dtypes) == {"a": "int", "b": "bigint", "c": "bigint", "user_id": "bigint"}


def test_default_group_keys(clicks, spark):
    out = aggregates.group_profile(clicks)
    assert "event_type" in out.columns and "amount_avg" in out.columns and out.count() == 3
    with pytest.raises(ValueError):
        aggregates.group_profile(spark.createDataFrame([(1.0,)], "x DOUBLE"))


@pytest.mark.parametrize("n", [1, 2, 5, 7, 40])
def test_tiles_equal_ntile(spark, n):
    count = 23
    df = spark.range(1, count + 1).withColumn("want", F.ntile(n).over(Window.orderBy("id")).cast("bigint"))
    got = df.select("want", ordered.tiles(F.col("id"), F.lit(count), n).alias("got"))
    assert got.filter("want <> got").count() == 0


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x DOUBLE")
    assert df.agg(values.mean("x")).first()[0] is None
    assert one(spark, r=values.ratio(F.lit(1), F.lit(0)), p=values.percent(F.lit(1), F.lit(0)))["r"] is None
