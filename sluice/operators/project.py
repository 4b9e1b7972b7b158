"""Projections, filters, profiling and type work driven by the schema."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.text import email_domain, to_boolean
from sluice.functions.values import percent, rows, total

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
NUMERIC = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
ID_COLUMNS = frozenset({"user_id", "event_id", "order_id", "product_id"})


def columns_of(df: DataFrame, kinds: tuple, skip: Iterable[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in skip]


def band(value: Column | str, steps: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first upper limit the value lies below, else ``rest``."""
    value = F.col(value) if isinstance(value, str) else value
    label = F.lit(rest)
    for limit, name in reversed(steps):
        label = F.when(value < limit, name).otherwise(label)
    return label


# The age groups.
AGE_BANDS = ((18, "minor"), (65, "adult"))


def age_group(age: Column | str) -> Column:
    return band(age, AGE_BANDS, "senior")


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is evaluated once per row.

    The optimizer copies a column's expression into every filter and projection it can move
    below; it does not do so for the output of a generator, so the value passes through one.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    The ``= 1`` filter lets Spark drop rows inside each task before the shuffle, so a hot key
    sends one row per task.
    """
    turn = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_turn", F.row_number().over(turn)).filter("_turn = 1").drop("_turn")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, deviation, minimum and maximum, one row per column, from one aggregation."""
    stats = {"count": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(
        *[fn(F.col(c).cast("double")).alias(f"{c}|{name}") for c in columns for name, fn in stats.items()]
    )
    lines = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}|{name}`").alias(name) for name in stats])
            for c in columns
        ]
    )
    return wide.select(F.inline(lines))


def null_profile(df: DataFrame) -> DataFrame:
    """Rows, nulls and null share of every column, from one aggregation."""
    wide = df.agg(
        rows().alias("_rows"), *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in df.schema.fields]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("row_count"),
                F.col(f.name).alias("null_count"),
            )
            for f in df.schema.fields
        ]
    )
    return wide.select(F.inline(lines)).withColumn("null_percent", percent("null_count", "row_count"))


def narrow_longs(df: DataFrame, skip: Iterable[str] = ID_COLUMNS) -> DataFrame:
    """LONG columns whose values fit become INT. One aggregated row of limits reaches the driver."""
    longs = columns_of(df, T.LongType, skip)
    if not longs:
        return df
    limits = df.agg(
        *[F.min(c).alias(f"{c}|min") for c in longs], *[F.max(c).alias(f"{c}|max") for c in longs]
    ).first()
    fits = [
        c
        for c in longs
        if limits[f"{c}|min"] is not None and limits[f"{c}|min"] >= INT_MIN and limits[f"{c}|max"] <= INT_MAX
    ]
    return df.withColumns({c: F.col(c).cast("int") for c in fits})


def retype(df: DataFrame, target: dict[str, str]) -> DataFrame:
    """Cast columns to the named types; text that does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in target.items()})


def flags_to_boolean(df: DataFrame) -> DataFrame:
    flags = [c for c in columns_of(df, T.StringType) if c.startswith("is_")]
    return df.withColumns({c: to_boolean(c) for c in flags}) if flags else df


def hot_columns_first(df: DataFrame, hot: Sequence[str]) -> DataFrame:
    lead = [c for c in hot if c in df.columns]
    return df.select(*lead, *[c for c in df.columns if c not in lead])


def date_parts(name: str) -> list[Column]:
    return [
        F.year(name).alias(f"{name}_year"),
        F.month(name).alias(f"{name}_month"),
        F.dayofweek(name).alias(f"{name}_dayofweek"),
    ]


def enrich(df: DataFrame) -> DataFrame:
    """All derived columns a schema allows, in one projection."""
    added: list[Column] = []
    if "age" in df.columns:
        added.append(age_group("age").alias("age_group"))
    if "email" in df.columns:
        added.append(email_domain("email").alias("email_domain"))
    for field in df.schema.fields:
        name, kind = field.name, field.dataType
        if isinstance(kind, TIMES):
            added += date_parts(name)
        elif isinstance(kind, T.MapType):
            added += [F.map_keys(name).alias(f"{name}_keys"), F.map_values(name).alias(f"{name}_values")]
        elif isinstance(kind, T.ArrayType):
            added.append(F.size(name).alias(f"{name}_size"))
    for name in columns_of(df, NUMERIC)[:3]:
        if name not in ID_COLUMNS:
            added.append(F.log1p(name).alias(f"{name}_log"))
            added.append(F.sqrt(F.abs(name)).alias(f"{name}_sqrt"))
    return df.select("*", *added)


def filtered_breakdown(
    df: DataFrame, categories: list[str], event_types: list[str], min_amount: float
) -> tuple[DataFrame, DataFrame]:
    """Count and amount by category and by event type, for the rows a dashboard selects."""
    chosen = df.filter(
        F.col("category").isin(categories)
        & F.col("event_type").isin(event_types)
        & (F.col("amount") >= min_amount)
    )
    measures = [rows().alias("events"), total("amount").alias("total_amount")]
    return chosen.groupBy("category").agg(*measures), chosen.groupBy("event_type").agg(*measures)


def by_time_part(df: DataFrame, part: Column, name: str) -> DataFrame:
    return df.groupBy(part.alias(name)).agg(rows().alias("events"), total("amount").alias("total_amount"))
