"""Aggregations, driven by the schema where they cover a whole table."""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.times import weekday_name
from sluice.functions.values import mean, money, percent, rows, total
from sluice.operators.ordered import quantiles
from sluice.operators.project import ID_COLUMNS, NUMERIC, TIMES, columns_of


def table_profile(df: DataFrame, skip: frozenset[str] = ID_COLUMNS) -> DataFrame:
    """Statistics of every numeric, text and time column, in one row from one aggregation."""
    out = [rows().alias("total_records")]
    for c in columns_of(df, NUMERIC, skip):
        out += [
            F.avg(c).alias(f"{c}_avg"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            F.stddev_samp(c).alias(f"{c}_stddev"),
        ]
    out += [F.countDistinct(c).alias(f"{c}_distinct") for c in columns_of(df, T.StringType)]
    for c in columns_of(df, TIMES):
        out += [F.min(c).alias(f"{c}_earliest"), F.max(c).alias(f"{c}_latest")]
    return df.agg(*out)


def default_keys(df: DataFrame) -> list[str]:
    keys = columns_of(df, T.StringType, {"name", "email"})
    return keys or [c for c in ("user_id",) if c in df.columns]


def group_profile(
    df: DataFrame, keys: list[str] | None = None, value_sets: tuple[str, ...] | None = ()
) -> DataFrame:
    """Count and sum, mean, minimum, maximum of the numeric columns per group.

    Without ``keys`` all text columns but names and e-mail addresses are the key, else the user. ``value_sets`` names
    text columns with a fixed small vocabulary, whose values are listed per group; None stands for all text columns that
    are left. For open-ended columns use :func:`value_list`, which gives one row per value.
    """
    keys = keys or default_keys(df)
    if value_sets is None:
        value_sets = tuple(columns_of(df, T.StringType, {"name", "email", *keys}))
    if not keys:
        raise ValueError("no columns to group by")
    out = [rows().alias("count")]
    for c in columns_of(df, NUMERIC, {*keys, *ID_COLUMNS}):
        out += [
            total(c).alias(f"{c}_sum"),
            mean(c).alias(f"{c}_avg"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    out += [F.sort_array(F.collect_set(c)).alias(f"{c}_values") for c in value_sets]
    return df.groupBy(*keys).agg(*out)


def largest_groups(profile: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """The groups with the most rows, of equal ones the first by key."""
    return profile.orderBy(F.desc("count"), *keys).limit(n)


def value_list(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The distinct values of a column per group with their counts, one row each."""
    return df.groupBy(*keys, column).agg(rows().alias("count"))


def monthly_counts(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
        .agg(rows().alias("count"))
        .orderBy("year", "month")
    )


def weekday_counts(df: DataFrame, ts: str) -> DataFrame:
    counted = df.groupBy(F.dayofweek(ts).alias("dayofweek")).agg(rows().alias("count"))
    return counted.withColumn("day_name", weekday_name("dayofweek")).orderBy("dayofweek")


def quartiles(df: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Exact quartiles of each column per key, or of the whole table."""
    keys = keys or []
    marks = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = [quantiles(df, keys, c, {f"{c}_{n}": p for n, p in marks.items()}) for c in columns]
    out = found[0]
    for more in found[1:]:
        other = more.withColumnsRenamed({k: f"_{k}" for k in keys})
        same = reduce(and_, [out[k].eqNullSafe(other[f"_{k}"]) for k in keys], F.lit(True))
        out = out.join(other, same).drop(*[f"_{k}" for k in keys])
    return out


def sign_split(df: DataFrame, value: str) -> DataFrame:
    """Sum, count and mean of the positive values, and the number of zeros."""
    v = F.col(value)
    positive = F.when(v > 0, v)
    return df.agg(
        F.coalesce(total(positive), F.lit(0.0)).alias("positive_value_sum"),
        F.count(positive).alias("positive_value_count"),
        F.count_if(v == 0).alias("zero_value_count"),
        mean(positive).alias("positive_value_avg"),
    )


def cube(df: DataFrame, dims: list[str], measures: list[Column]) -> DataFrame:
    """All combinations of the dimensions; ``grouping_id`` tells a total from a null value."""
    return df.cube(*dims).agg(F.grouping_id().cast("int").alias("grouping_id"), *measures)


def rollup(df: DataFrame, dims: list[str], measures: list[Column]) -> DataFrame:
    return df.rollup(*dims).agg(F.grouping_id().cast("int").alias("grouping_id"), *measures)


def reduced_per(df: DataFrame, dims: list[str], who: str, amount: str) -> tuple[DataFrame, list[Column]]:
    """One row per dimensions and ``who``, and the measures over such rows: events, amount and distinct ``who``.

    For cubes and rollups, which copy every row once per grouping: so only reduced rows are copied.
    """
    exact = F.try_sum(money(amount))
    small = df.groupBy(*dims, who).agg(
        rows().alias("_n"), exact.alias("_exact"), F.sum(F.col(amount).cast("double")).alias("_near"),
        (F.count(amount) - F.count(money(amount))).alias("_misfits"),
    )
    whole = F.when(F.sum("_misfits") == 0, F.try_sum("_exact").cast("double"))
    return small, [
        F.sum("_n").alias("event_count"),
        F.coalesce(whole, F.sum("_near")).alias("total_value"),
        F.countDistinct(who).alias("unique_users"),
    ]


def count_and_amount_pivot(df: DataFrame, row: str, column: str, values: list[str], amount: str) -> DataFrame:
    """The column values are given, so no extra job has to look for them."""
    return (
        df.groupBy(row)
        .pivot(column, values)
        .agg(F.count(F.lit(1)).alias("count"), total(amount).alias("total_amount"))
    )


def shares(df: DataFrame, keys: list[str], present: str | None = None) -> DataFrame:
    """Count per group and its percentage of *all* rows, also those without a value."""
    seen = F.count(present) if present else rows()
    grouped = df.groupBy(*keys).agg(seen.alias("count"), rows().alias("_all"))
    # The total comes from the grouped rows, whose shuffle is used twice.
    everything = grouped.agg(F.sum("_all")).scalar()
    return grouped.filter("count > 0").drop("_all").withColumn("percentage", percent("count", everything))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson coefficient of every pair of columns, over the whole table in one pass."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    lines = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs]
    return wide.select(F.inline(F.array(*lines)))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Rows per bin of equal width between the smallest and the largest value."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    n = F.least(F.width_bucket(F.col(column), low, high, F.lit(bins)), F.lit(bins))
    return df.filter(F.col(column).isNotNull()).groupBy(n.alias("bin")).agg(rows().alias("count"))


def weekday_hour_table(df: DataFrame, ts: str) -> DataFrame:
    """Counts by weekday (Monday first) and hour of day, zero where nothing happened."""
    hours = list(range(24))
    table = (
        df.select(F.weekday(ts).alias("weekday"), F.dayofweek(ts).alias("_day"), F.hour(ts).alias("_hour"))
        .groupBy("weekday", weekday_name("_day").alias("day_name"))
        .pivot("_hour", hours)
        .count()
    )
    named = table.select("weekday", "day_name", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    return named.fillna(0).orderBy("weekday")
