"""Sessions and event paths, built in steps that never hold a whole user in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.times import micros
from sluice.functions.values import combined_total, partial_total, rows
from sluice.operators.ordered import SLICE, SLICE_ROWS, hot_slices, ordered_scan


def sessions(
    events: DataFrame, key: str, ts: str, value: str, label: str, gap_seconds: int = 1800,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Runs of events of a key with at most the gap between neighbours.

    A session ends one gap after its last event. First each (key, slice of time) is cut into
    partial sessions; only those, at most a few per slice, are then merged per key.
    """
    gap = gap_seconds * 1_000_000
    slim = events.select(key, label, F.col(value).alias("_value"), micros(ts).alias("_us"), F.col(ts).alias("_ts"))
    flagged, slices = hot_slices(slim, [key], "_us", slice_rows=slice_rows)
    rows_in = flagged.withColumn(SLICE, F.lit(0) if slices is None else slices)
    local = Window.partitionBy(key, SLICE).orderBy("_us")
    starts = F.coalesce(F.col("_us") - F.lag("_us").over(local) > gap, F.lit(True))
    partial = (
        rows_in.withColumn("_new", starts.cast("int"))
        .withColumn("_run", F.sum("_new").over(local.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, SLICE, "_run")
        .agg(
            F.min("_us").alias("_from"),
            F.max("_us").alias("_to"),
            F.min("_ts").alias("_start"),
            F.max("_ts").alias("_end"),
            rows().alias("_n"),
            *partial_total("_value"),
            F.collect_set(label).alias("_labels"),
        )
    )
    turn = Window.partitionBy(key).orderBy("_from")
    apart = F.coalesce(F.col("_from") - F.lag("_to").over(turn) > gap, F.lit(True))
    merged = (
        partial.withColumn("_new", apart.cast("int"))
        .withColumn("_run", F.sum("_new").over(turn.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(key, "_run")
        .agg(
            F.min("_start").alias("session_start"),
            (F.max("_end") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"),
            ((F.max("_to") + gap - F.min("_from")) / F.lit(60_000_000)).alias("duration_minutes"),
            F.sum("_n").alias("event_count"),
            combined_total().alias("total_value"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("_labels")))).alias("event_types"),
        )
    )
    return merged.drop("_run")


def behavior_paths(
    events: DataFrame, minutes: int = 30, segment: int = 1000, steps: tuple[str, ...] = ("view", "click", "purchase")
) -> DataFrame:
    """Ordered path of a session within fixed windows, with its duration, value and conversion.

    A path is written in segments of at most ``segment`` events, so no row grows without
    limit; nearly all paths have one. The conversion flag says whether the steps occur in
    this order anywhere in the whole path, across its segments. An event without a type is left out of the path.
    """
    keys = ["session_id", "user_id", "window_start"]
    framed = events.select(
        "session_id", "user_id", "event_id", "event_type", "amount", "timestamp",
        F.window("timestamp", f"{minutes} minutes").start.alias("window_start"), micros("timestamp").alias("_us"),
    )
    flagged, slices = hot_slices(framed, keys, "_us", "event_id")
    placed = ordered_scan(flagged, keys, ["timestamp", "event_id"], slices, sums={"_pos": F.lit(1)}).withColumn("segment", F.floor((F.col("_pos") - 1) / segment))
    # The state after a segment, for every state it can be entered in: how many steps are done.
    kinds = F.transform(F.sort_array(F.collect_list(F.struct("_pos", "event_type"))), lambda e: e["event_type"])
    parts = placed.groupBy(*keys, "segment").agg(kinds.alias("_kinds"), F.min("timestamp").alias("_from"), F.max("timestamp").alias("_to"), *partial_total("amount"))
    # A first segment is entered with no step done, so it needs one walk only.
    first, *later = [_advance(F.col("_kinds"), steps, F.lit(state)) for state in range(len(steps) + 1)]
    after = F.when(F.col("segment") == 0, F.array(first)).otherwise(F.array(first, *later))
    told = parts.select("*", F.array_join("_kinds", " -> ").alias("event_sequence"), after.alias("_after")).drop("_kinds")
    # A row per segment; what is said of the whole path is folded over these few rows.
    path = Window.partitionBy(*keys)
    states = F.transform(F.sort_array(F.collect_list(F.struct("segment", "_after")).over(path)), lambda s: s["_after"])
    final = F.aggregate(states, F.lit(0), lambda state, after: F.get(after, state))
    return told.select(
        *keys,
        "segment",
        "event_sequence",
        ((micros(F.max("_to").over(path)) - micros(F.min("_from").over(path))) / F.lit(1_000_000)).alias("duration_seconds"),
        combined_total(path).alias("total_value"),
        (final == len(steps)).alias("converted"),
    )


def _advance(kinds, steps: tuple[str, ...], state):
    """Walk through the events of a segment, counting the steps met in order.

    A step is met where an event's name contains it, as ``LIKE '%step%step%'`` over the joined path has it; one name may meet
    several, each behind the one before.
    """

    def through(done, kind):
        here = F.struct(done.alias("done"), F.lit(1).alias("place"))
        for n, step in enumerate(steps):
            found = F.position(F.lit(step), kind, here["place"])
            met = (here["done"] == n) & (found > 0)
            here = F.struct(
                F.when(met, here["done"] + 1).otherwise(here["done"]).alias("done"),
                F.when(met, found + len(step)).otherwise(here["place"]).alias("place"),
            )
        return here["done"]

    return F.aggregate(kinds, state, through)
