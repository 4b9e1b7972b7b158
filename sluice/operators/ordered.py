"""Ordered computations that never put one whole key into one task.

``Window.partitionBy(key)`` hands all rows of a key to a single task, which fails once one
key holds a large part of the data. The operators here cut each key into consecutive slices
(a stretch of time, or of values), work inside (key, slice), and bring in what
earlier slices contribute through one extra *carry row* per slice:

* running sums and positions carry the totals of all earlier slices,
* previous / following values carry the last row before or the first row after the slice.

The carry rows come from a partial aggregation, so only one small row per (key, slice) is
ever gathered per key. Results equal those of the plain window function.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from sluice.functions.times import micros
from sluice.functions.values import AMOUNT, col, money, ratio, spread
from sluice.session import settled

# How many rows a slice should hold: enough to sort in one task without trouble.
SLICE_ROWS = 2_000_000

SLICE = "_slice"
HOT = "_hot"
KIND = "_kind"
BEFORE, DATA, AFTER = 0, 1, 2


def hot_slices(
    df: DataFrame, keys: list[str], by: str, tie: str | None = None, on: str | None = None, slice_rows: int = SLICE_ROWS
) -> tuple[DataFrame, Column | None]:
    """The table with its hot keys marked, and the slice of each row along the numeric ``by``.

    Keys with more than ``slice_rows`` rows are cut at quantiles of their own rows, so a slice
    holds about that many however the rows lie: one stray value or a burst changes nothing. A
    value that fills slices alone is cut further by ``tie``. All other keys stay whole and cost
    no carry rows. At most ``rows / slice_rows`` keys are hot, which bounds the marked list.
    ``on`` names the column that the slices are read from, if it is not ``by``. Without any hot key there are no slices (None), and
    the steps that would join them fall away.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_rows)
    total_rows = counted.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    if not total_rows:
        return df.withColumn(HOT, F.lit(False)), None
    marked = counted.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias(HOT))
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    flagged = df.join(F.broadcast(marked), same, "left").drop(*[f"_hot_{k}" for k in keys])
    flagged = flagged.withColumn(HOT, F.coalesce(HOT, F.lit(False)))
    slices = value_slices(flagged.filter(HOT), by, tie, int(total_rows // slice_rows) + 1, on)
    return flagged, F.when(F.col(HOT), slices).otherwise(F.lit(0)).cast("bigint")


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    slice_key: Column | None,
    sums: dict[str, Column] | None = None,
    previous: dict[str, Column | str] | None = None,
    following: dict[str, Column | str] | None = None,
    peers: bool = False,
) -> DataFrame:
    """Add running sums and neighbour values per key, in ascending ``order``.

    ``slice_key`` must not decrease along ``order`` within a key. With ``peers`` a running sum
    includes all rows that tie with the current one (a RANGE frame); otherwise ties follow
    ``order``, which then should end in a unique column. Without slices (None) every key stays whole.
    """
    sums, previous, following = sums or {}, previous or {}, following or {}
    if slice_key is None:
        return _whole_keys(df, keys, order, sums, previous, following, peers)
    inputs = {f"_in_{n}": col(c) for n, c in {**sums, **previous, **following}.items()}
    rows = df.withColumns({SLICE: slice_key, KIND: F.lit(DATA), **inputs})

    place = F.struct(*order)
    parts = [F.sum(f"_in_{n}").alias(f"_in_{n}") for n in sums]
    if previous:
        parts.append(F.max_by(F.struct(*[f"_in_{n}" for n in previous]), place).alias("_last"))
    if following:
        parts.append(F.min_by(F.struct(*[f"_in_{n}" for n in following]), place).alias("_first"))
    slices = rows.groupBy(*keys, SLICE).agg(*parts)

    in_turn = Window.partitionBy(*keys).orderBy(SLICE)
    earlier = in_turn.rowsBetween(Window.unboundedPreceding, -1)
    ahead = [F.sum(f"_in_{n}").over(earlier).alias(f"_in_{n}") for n in sums]
    if previous:
        neighbour = F.lag("_last").over(in_turn)
        ahead += [neighbour[f"_in_{n}"].alias(f"_in_{n}") for n in previous]
    both = rows.unionByName(
        slices.select(*keys, SLICE, F.lit(BEFORE).alias(KIND), *ahead), allowMissingColumns=True
    )
    if following:
        neighbour = F.lead("_first").over(in_turn)
        behind = [neighbour[f"_in_{n}"].alias(f"_in_{n}") for n in following]
        both = both.unionByName(
            slices.select(*keys, SLICE, F.lit(AFTER).alias(KIND), *behind), allowMissingColumns=True
        )

    local = Window.partitionBy(*keys, SLICE).orderBy(KIND, *order)
    running = local if peers else local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {n: F.sum(f"_in_{n}").over(running) for n in sums}
    added |= {n: F.lag(f"_in_{n}").over(local) for n in previous}
    added |= {n: F.lead(f"_in_{n}").over(local) for n in following}
    return both.withColumns(added).filter(F.col(KIND) == DATA).drop(SLICE, KIND, *inputs)


def _whole_keys(
    df: DataFrame, keys: list[str], order: list[str], sums: dict, previous: dict, following: dict, peers: bool
) -> DataFrame:
    """The plain windows, for keys that are known to be small."""
    local = Window.partitionBy(*keys).orderBy(*order)
    running = local if peers else local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {n: F.sum(col(c)).over(running) for n, c in sums.items()}
    added |= {n: F.lag(col(c)).over(local) for n, c in previous.items()}
    added |= {n: F.lead(col(c)).over(local) for n, c in following.items()}
    return df.withColumns(added)


def moving_sums(
    df: DataFrame,
    keys: list[str],
    order: str,
    span: int,
    sums: dict[str, Column],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Running sums over the rows from ``span`` units before the current row up to its peers.

    ``order`` is an integer column (for example microseconds). Equals a RANGE frame of
    ``span PRECEDING``, at constant cost per row: every row is added at its own place and
    taken off again right after ``order + span``. Use exact (integer or decimal) inputs.
    """
    names = {n: f"_add_{n}" for n in sums}
    flagged, slices = hot_slices(df, keys, order, on="_at", slice_rows=slice_rows)
    rows = flagged.withColumns({names[n]: c for n, c in sums.items()})
    arrive = rows.withColumns({"_at": F.col(order), "_leave": F.lit(0)})
    depart = rows.select(
        *keys,
        HOT,
        (F.col(order) + F.lit(span)).alias("_at"),
        F.lit(1).alias("_leave"),
        *[(-F.col(a)).alias(a) for a in names.values()],
    )
    both = arrive.unionByName(depart, allowMissingColumns=True)
    scanned = ordered_scan(
        both,
        keys,
        ["_at", "_leave"],
        slices,
        sums={n: F.col(a) for n, a in names.items()},
        peers=True,
    )
    return scanned.filter(F.col("_leave") == 0).drop("_at", "_leave", HOT, *names.values())


def moving_statistics(
    df: DataFrame, keys: list[str], ts: str, value: str, seconds: int, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Moving count, mean and sample deviation of an amount over the preceding seconds.

    Amounts below 10**12 are added and taken off as exact decimals, their squares with twenty decimals (six from
    100,000 on). Larger ones go as DOUBLE in sums of their own, which count only where a frame holds such an
    amount. A frame with NaN, an infinity or an amount from 10**150 on has NaN for mean and deviation; others are not touched by it.
    """
    million = 1_000_000
    known, amount, v = F.col(value).isNotNull(), money(value), F.col(value).cast("double")
    fits = F.coalesce(F.abs(amount) < F.lit(10**12), F.lit(False))
    small = fits & (F.abs(amount) < F.lit(10**5))
    odd = known & ~fits
    wild = odd & ~F.coalesce(F.abs(v) < 1e150, F.lit(False))
    exact = F.when(small, amount).try_cast("decimal(15,10)")
    scanned = moving_sums(
        df.withColumn("_us", micros(ts)),
        keys,
        "_us",
        seconds * million,
        {
            "_n": known.cast("int"),
            "_odd": odd.cast("int"),
            "_wild": wild.cast("int"),
            "_sum": F.when(fits, amount).otherwise(F.lit(0).cast(AMOUNT)),
            "_squares": F.coalesce(exact * exact, F.lit(0).cast("decimal(31,20)")),
            "_large_squares": F.when(fits & ~small, amount * amount).otherwise(F.lit(0).cast("decimal(38,6)")),
            "_odd_sum": F.when(odd & ~wild, v).otherwise(0.0),
            "_odd_squares": F.when(odd & ~wild, v * v).otherwise(0.0),
        },
        slice_rows,
    )
    is_odd, is_wild, nan = F.col("_odd") > 0, F.col("_wild") > 0, F.lit(float("nan"))
    plain = F.col("_sum").cast("double")
    whole = F.when(is_odd, plain + F.col("_odd_sum")).otherwise(plain)
    squares = F.col("_squares").cast("double") + F.col("_large_squares").cast("double")
    squares = F.when(is_odd, squares + F.col("_odd_squares")).otherwise(squares)
    return scanned.withColumns(
        {
            "moving_count": F.col("_n"),
            "moving_mean": F.when(is_wild, nan).otherwise(ratio(whole, F.col("_n"))),
            "moving_stddev": F.when(F.col("_n") > 1, F.when(is_wild, nan).otherwise(spread(F.col("_n"), whole, squares))),
        }
    ).drop("_us", "_n", "_odd", "_wild", "_sum", "_squares", "_large_squares", "_odd_sum", "_odd_squares")


def value_slices(
    df: DataFrame, by: str, tie: str | None = None, parts: int | None = None, on: str | None = None
) -> Column:
    """Slice number for ranking on a numeric column, from sketched quantiles.

    The driver receives the ``parts`` quantiles (as many as the row count asks for) and
    nothing else. A value so frequent that it covers several quantiles gets a slice of its
    own, cut further by the quantiles of ``tie``. The slices only have to follow the order;
    sketch errors change their size, not the result.
    """
    parts = parts or max(2, df.count() // SLICE_ROWS + 1)
    marks = [i / parts for i in range(1, parts)]
    columns = [by] if tie is None else [by, tie]
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    found = numeric.stat.approxQuantile(columns, marks, 0.5 / parts)
    cuts = sorted(set(found[0]))
    heavy = sorted({v for v in cuts if found[0].count(v) > 1})
    edges = sorted(set(cuts) | {math.nextafter(v, math.inf) for v in heavy})
    at = F.col(on or by).cast("double")
    place = _bucket(at, edges)
    if tie is None:
        return place.cast("bigint")
    tie_edges = sorted(set(found[1]))
    inner = F.when(at.isin(heavy), _bucket(F.col(tie).cast("double"), tie_edges))
    return (place * F.lit(len(tie_edges) + 1) + F.coalesce(inner, F.lit(0))).cast("bigint")


def nulls_last(by: str, slices: Column) -> tuple[list[str], Column]:
    """Order columns and slices for a descending order on ``_by``, in which rows without a value come last."""
    return ["_none", "_by"], F.when(F.col(by).isNull(), F.lit(2**62)).otherwise(slices)


def _bucket(value: Column, edges: list[float], block: int = 64) -> Column:
    """Number of edges at or below the value; nulls first.

    A balanced tree of comparisons finds a block of edges, which is then counted through, so
    the expression stays small with thousands of edges.
    """
    blocks = [edges[i : i + block] for i in range(0, len(edges), block)]
    heads = [b[0] for b in blocks[1:]]

    def within(i: int) -> Column:
        if not blocks:
            return F.lit(0)
        inside = F.filter(F.array(*[F.lit(e) for e in blocks[i]]), lambda e: e <= value)
        return F.lit(i * block) + F.size(inside)

    def below(lo: int, hi: int) -> Column:
        if lo == hi:
            return within(lo)
        mid = (lo + hi) // 2
        return F.when(value < F.lit(heads[mid]), below(lo, mid)).otherwise(below(mid + 1, hi))

    return F.when(value.isNull(), F.lit(-1)).otherwise(below(0, len(heads)))


def row_numbers(
    df: DataFrame,
    by: str,
    ties: list[str],
    descending: bool = False,
    parts: int | None = None,
    name: str = "position",
) -> DataFrame:
    """Number all rows of a table from 1, ordered by the numeric ``by`` and then by ``ties``.

    Rows without a value come first, on a descending order last, as Spark has it.

    ``ties`` must make the order unique. When its first column is numeric, a value shared by
    very many rows is cut by that column. The table is read several times; settle the result
    of costly steps first.
    """
    keyed = df.withColumn("_by", -F.col(by) if descending else F.col(by)).withColumn("_none", F.col(by).isNull() & F.lit(descending))
    cut = ties[0] if isinstance(df.schema[ties[0]].dataType, NumericType) else None
    order, slices = ["_by"], value_slices(keyed, "_by", cut, parts)
    if descending:
        order, slices = nulls_last(by, slices)
    numbered = ordered_scan(keyed, [], [*order, *ties], slices, sums={name: F.lit(1)})
    return numbered.drop("_by", "_none")


def value_ranks(df: DataFrame, by: str, descending: bool = False, parts: int | None = None) -> DataFrame:
    """One row per distinct value with its rank, dense rank and percent rank in the table.

    Null is a value too: the first one, on a descending order the last. Attach the ranks with
    :func:`with_ranks`, which keeps rows without a value.

    Rows are counted per value first, so ties of any size shuffle as one row per task.
    """
    counted = df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    counted = settled(
        counted.withColumn("_by", -F.col(by) if descending else F.col(by)).withColumn("_none", F.col(by).isNull() & F.lit(descending))
    )
    order, slices = ["_by"], value_slices(counted, "_by", parts=parts)
    if descending:
        order, slices = nulls_last(by, slices)
    ranked = ordered_scan(
        counted,
        [],
        order,
        slices,
        sums={"_through": F.col("_n"), "dense_rank": F.lit(1)},
    )
    everyone = counted.agg(F.sum("_n").alias("n")).scalar()
    return ranked.select(
        by,
        (F.col("_through") - F.col("_n") + 1).alias("rank"),
        "dense_rank",
        F.coalesce(
            F.try_divide(
                (F.col("_through") - F.col("_n")).cast("double"), (everyone - 1).cast("double")
            ),
            F.lit(0.0),
        ).alias("percent_rank"),
    )


def with_ranks(df: DataFrame, ranks: DataFrame, by: str) -> DataFrame:
    """Every row with the ranks of its value, also of a missing one."""
    ranked = ranks.withColumnRenamed(by, "_ranked")
    return df.join(ranked, F.col(by).eqNullSafe(F.col("_ranked"))).drop("_ranked")


def quantiles(
    df: DataFrame, keys: list[str], value: str, marks: dict[str, float], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Exact quantiles, one row per key: the smallest value that at least this share of the known values does not exceed.

    Rows are counted per value first, so ties shuffle as one row per task, and a key with very many values is cut into
    slices. Null is no value; a key without values has null quantiles, and so has an empty table without keys.
    ``marks`` names the quantiles.
    """
    named = df.groupBy(*keys, F.col(value).alias("_value")).agg(F.count(value).alias("_n"))
    counted = settled(named.select(F.struct(*keys, F.lit(0)).alias("_key"), "_value", "_n"))
    flagged, slices = hot_slices(counted, ["_key"], "_value", slice_rows=slice_rows)
    scanned = ordered_scan(flagged, ["_key"], ["_value"], slices, sums={"_through": F.col("_n")})
    known = counted.groupBy(F.col("_key").alias("_whole")).agg(F.sum("_n").alias("_all"))
    reached = [
        F.min(F.when(F.col("_through") >= F.greatest(F.lit(1), F.ceil(F.col("_all") * share)), F.col("_value"))).alias(name)
        for name, share in marks.items()
    ]
    both = scanned.join(known, F.col("_key") == F.col("_whole"))
    if not keys:
        return both.agg(*reached)
    return both.groupBy("_key").agg(*reached).select(*[F.col("_key")[k].alias(k) for k in keys], *marks)


def tiles(position: Column, count: Column, n: int) -> Column:
    """The NTILE(n) number of a row from its position and the row count."""
    small = F.floor(count / F.lit(n))
    extra = count % n
    in_big = extra * (small + 1)
    return F.when(
        position <= in_big, F.floor((position - 1) / (small + 1)) + 1
    ).otherwise(extra + F.floor(F.try_divide(position - 1 - in_big, small)) + 1)
