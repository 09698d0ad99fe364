"""Summaries that merge: quantile and distinct-value sketches kept per group, and what can be read from them.

A sketch of a month is computed once and stored; sketches of months unite to that of the year without the rows. The
figures are estimates with a stated error; exact ones are in ``ranking`` and ``profile``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tabsift.functions.columns import col, linear_probs
from tabsift.operators.ranking import stacked

# Size of a quantile sketch: its rank error is about 2.3 / size^0.9 of the rows (1.33 % at 200).
KLL_SIZE = 1000
# Places between 0 and 1 at which a sketch is read to count the rows below a value.
GRID = 1024
# Buckets of a distinct sketch are 2^this; its relative error is about 1.04 / sqrt(buckets) (one deviation).
HLL_BITS = 14


def rank_error(size: int = KLL_SIZE) -> float:
    """By how much a share of rows read from a quantile sketch may be off (99 % of the time): the sketch and the grid."""
    return 2.296 / size**0.9021 + 1.0 / GRID


def distinct_error(bits: int = HLL_BITS) -> float:
    """The relative standard error of a number of distinct values."""
    return 1.04 / math.sqrt(2**bits)


def _number(value: Column) -> Column:
    # Neither NULL nor NaN is a place in an order.
    value = value.cast("double")
    return F.when(~F.isnan(value), value + F.lit(0.0))


def quantile_sketches(df: DataFrame, by: list[str], names: list[str], size: int = KLL_SIZE) -> DataFrame:
    """``by, feature, n, sketch``: one quantile sketch of the present values per group and column."""
    long = stacked(df, by, {c: [_number(col(c))] for c in names}, ["value"]).filter(F.col("value").isNotNull())
    return long.groupBy(*(col(b) for b in by), "feature").agg(
        F.count("value").alias("n"), F.kll_sketch_agg_double("value", size).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Quantile sketches of finer groups as those of ``by`` and feature."""
    return sketches.groupBy(*(col(b) for b in by), "feature").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketched_edges(sketch: Column, bins: int) -> Column:
    """Distinct sorted bin edges between the quantiles of a sketch."""
    probs = F.array(*(F.lit(p) for p in linear_probs(bins)))
    return F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double(sketch, probs)))


def sketch_grid(sketch: Column) -> Column:
    """The quantiles of a sketch at the places of the grid."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*(F.lit((i + 0.5) / GRID) for i in range(GRID))))


def rows_between(grid: Column, n: Column, low: Column, high: Column, first: Column) -> Column:
    """Rows of a sketch in (low, high], from its grid; ``first`` takes all up to high."""
    def below(x: Column) -> Column:
        return F.size(F.filter(grid, lambda q: q <= x)) / F.lit(float(GRID)) * n

    return below(high) - F.when(first, F.lit(0.0)).otherwise(below(low))


def distinct_sketches(df: DataFrame, by: list[str], names: list[str], bits: int = HLL_BITS) -> DataFrame:
    """``by, feature, n_rows, n_valid, sketch``: one sketch of the distinct present values per group and column."""
    long = stacked(df, by, {c: [col(c).cast("string")] for c in names}, ["value"])
    return long.groupBy(*(col(b) for b in by), "feature").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_valid"),
        F.hll_sketch_agg("value", bits).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Distinct sketches of finer groups as those of ``by`` and feature."""
    return sketches.groupBy(*(col(b) for b in by), "feature").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_valid").alias("n_valid"), F.hll_union_agg("sketch").alias("sketch"))


def distinct_counts(sketches: DataFrame, by: list[str] = []) -> DataFrame:
    """``by, feature, n_rows, n_valid, n_unique``; n_unique is an estimate (see ``distinct_error``)."""
    return sketches.select(
        *(col(b) for b in by), "feature", "n_rows", "n_valid", F.hll_sketch_estimate("sketch").alias("n_unique"))
