"""Column helpers for amounts, ratios and exact sums.

Amounts are summed as wide DECIMAL, so a total does not depend on the order in which tasks
finish, and are handed out as DOUBLE. Values that do not fit are summed as DOUBLE instead.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Ten decimals and twenty digits before them; sums have eight digits more.
AMOUNT = "decimal(30,10)"


def money(c: Column | str) -> Column:
    """The value as an exact amount; null when it has more than twenty digits or is not finite."""
    return col(c).try_cast(AMOUNT)


def cents(c: Column | str) -> Column:
    """Prices that are stored with two decimals."""
    return col(c).cast("decimal(18,2)")


def total(c: Column | str) -> Column:
    """The exact sum, or the DOUBLE sum once a value or the sum does not fit."""
    exact = F.when(F.count(money(c)) == F.count(col(c)), F.try_sum(money(c)).cast("double"))
    return F.when(F.count(col(c)) > 0, F.coalesce(exact, F.sum(col(c).cast("double"))))


def mean(c: Column | str) -> Column:
    """Exact sum over the count of non-null values; null for an empty group."""
    return F.try_divide(total(c), F.count(col(c)))


def partial_total(c: Column | str) -> list[Column]:
    """What :func:`combined_total` and :func:`combined_mean` need of a first aggregation."""
    return [
        F.count(col(c)).alias("_values"), F.count(money(c)).alias("_exact"), F.try_sum(money(c)).alias("_money"),
        F.sum(col(c).cast("double")).alias("_double"),
    ]


def combined_total(over: WindowSpec | None = None) -> Column:
    """:func:`total` over the groups of a first aggregation, or over the rows of a window of them."""

    def all_of(c: Column) -> Column:
        return c if over is None else c.over(over)

    known, exact = all_of(F.sum("_values")), all_of(F.sum("_exact"))
    whole = all_of(F.count_if(F.col("_exact") > 0)) == all_of(F.count("_money"))  # no partial sum left its type
    money_sum = F.when((exact == known) & whole, all_of(F.try_sum("_money")).cast("double"))
    return F.when(known > 0, F.coalesce(money_sum, all_of(F.sum("_double"))))


def combined_mean() -> Column:
    return F.try_divide(combined_total(), F.sum("_values"))


def total_over(c: Column | str, over: WindowSpec) -> Column:
    """:func:`total` over a window: exact, or the DOUBLE sum where a value or the sum does not fit."""
    known = F.count(col(c)).over(over)
    exact = F.when(F.count(money(c)).over(over) == known, F.try_sum(money(c)).over(over).cast("double"))
    return F.when(known > 0, F.coalesce(exact, F.sum(col(c).cast("double")).over(over)))


def rows() -> Column:
    return F.count(F.lit(1))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Null instead of an error when the whole is zero."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double"))


def percent(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(col(part).cast("double") * 100.0, col(whole).cast("double"))


def growth(now: Column | str, before: Column | str) -> Column:
    return F.try_divide((col(now) - col(before)) * 100.0, col(before))


def spread(n: Column, sum_x: Column, sum_xx: Column) -> Column:
    """Sample standard deviation from a count, a sum and a sum of squares."""
    d = n.cast("double")
    x = sum_x.cast("double")
    return F.sqrt(
        F.greatest(F.try_divide(sum_xx.cast("double") - F.try_divide(x * x, d), d - 1.0), F.lit(0.0))
    )
