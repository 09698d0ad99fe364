"""Column expressions shared by the operators. All stay on the JVM side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives NULL instead of an ANSI error on a zero divisor."""
    return F.try_divide(top, bottom)


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation over rows with both present; NULL for a constant side.

    The built-in ``corr`` raises DIVIDE_BY_ZERO on a constant column in ANSI mode.
    """
    both = x.isNotNull() & y.isNotNull()
    return ratio(
        F.covar_pop(x, y), F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
    )


def round_half_even(x: Column, places: int = 2) -> Column:
    """Scale, round to the even integer, scale back: binary floats, not decimal text."""
    scale = float(10**places)
    return F.rint(x * scale) / scale


def linear_probs(bins: int) -> list[float]:
    """``bins + 1`` evenly spaced probabilities as multiples of one step."""
    return [i * (1.0 / bins) for i in range(bins)] + [1.0]


def closed_right_bin(x: Column, edges: Column, most: int) -> Column:
    """0-based bin in [e0,e1], (e1,e2], ...; NULL when there are fewer than two edges.

    A missing value (NULL or NaN) has no bin (NULL), one below the first edge has bin -1, and one above the last
    edge the number of the bin after the last. ``edges`` is a sorted array of distinct values, at most ``most`` of
    them. A sum of comparisons is compiled; a higher-order filter() would not be.
    """
    below = reduce(
        lambda a, b: a + b,
        (F.when(F.get(edges, F.lit(i)) < x, 1).otherwise(0) for i in range(most)),
    )
    inside = F.when(x < F.get(edges, F.lit(0)), -1).otherwise(F.greatest(below, F.lit(1)) - 1)
    return F.when((F.size(edges) >= 2) & x.isNotNull() & ~F.isnan(x.cast("double")), inside)
