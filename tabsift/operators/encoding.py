"""Text features of any number of categories as numbers: target means that never see the row's own label.

Rows have a place in [0, 1) that has nothing to do with the label, a hash of the ids as a rule. A training row gets the
mean of the labels of its category before it in that order, drawn towards the overall mean; a row to be scored gets the
mean of all. A category's rows are cut into blocks of the order: the blocks before give one sum each, the rows before
inside the block a running one, so a category that fills a third of the table is spread over as many tasks as it has
blocks. No list of categories reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabsift.functions.columns import col, ratio
from tabsift.operators.ranking import stacked
from tabsift.roles import Roles
from tabsift.session import scratch_path
from tabsift.sources.sinks import read_stage, write_stage

# Labels that the overall mean counts for.
PRIOR_WEIGHT = 10.0
MISSING = "missing"
SUFFIX = "__mean"


def hashed_place(ids: list[str], seed: int = 42) -> Column:
    """A number in [0, 1) from the ids: the same on any cluster."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit("place"), *(col(c) for c in ids)), F.lit(1 << 52)).cast("double") / float(1 << 52)


def _categories(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    return stacked(rows, keys, {f: [F.coalesce(col(f).cast("string"), F.lit(MISSING))] for f in names}, ["category"])


def _spread(long: DataFrame, rows: DataFrame, names: list[str]) -> DataFrame:
    """Long values (``__row, feature, value``) as columns of the rows."""
    wide = long.groupBy("__row").agg(*(F.max(F.when(F.col("feature") == f, F.col("value"))).alias(f"{f}{SUFFIX}") for f in names))
    return rows.join(wide, "__row", "left").drop("__row")


def _numbered(df: DataFrame, **columns: Column) -> DataFrame:
    """The rows written once with a number of their own, which all later steps read."""
    path = scratch_path(df.sparkSession, "encoding")
    write_stage(df.withColumns({"__row": F.monotonically_increasing_id(), **columns}), path)
    return read_stage(df.sparkSession, path)


def target_means(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """``feature, category, total, n`` of the labelled rows; a missing value is a category. For rows to be scored."""
    known = df.filter(col(target).isNotNull()).withColumn("__y", col(target).cast("double"))
    return _categories(known, ["__y"], names).groupBy("feature", "category").agg(F.sum("__y").alias("total"), F.count("__y").alias("n"))


def overall_mean(df: DataFrame, target: str) -> float:
    found = df.agg(F.avg(col(target).cast("double"))).first()[0]
    return 0.0 if found is None else found


def ordered_target_means(
    df: DataFrame, names: list[str], target: str, place: Column, prior_weight: float = PRIOR_WEIGHT, blocks: int | None = None,
) -> DataFrame:
    """The rows with ``<feature>__mean`` for each of ``names``: the mean label of the rows of the same category before
    it in the order of ``place``, with the overall mean as ``prior_weight`` labels more.

    Rows without a label are counted nowhere but get a value. Rows of equal place are ordered by their number. ``blocks``
    of the order share the work of a category (default: four per shuffle task).
    """
    if not names:
        return df
    blocks = blocks or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mean = overall_mean(df, target)
    rows = _numbered(df, __place=place.cast("double"), __y=col(target).cast("double"))
    block = F.least(F.floor(F.col("__place") * blocks), F.lit(blocks - 1)).cast("int")
    long = _categories(rows, ["__row", "__place", "__y"], names).withColumn("block", block)
    group = ["feature", "category"]
    parts = long.groupBy(*group, "block").agg(F.sum("__y").alias("total"), F.count("__y").alias("n"))
    earlier = Window.partitionBy(*group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per block
    shifts = parts.select(
        *group, "block", F.coalesce(F.sum("total").over(earlier), F.lit(0.0)).alias("total_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"))
    inside = Window.partitionBy(*group, "block").orderBy("__place", "__row").rowsBetween(Window.unboundedPreceding, -1)
    running = long.select(
        "__row", *group, "block", F.coalesce(F.sum("__y").over(inside), F.lit(0.0)).alias("total_inside"),
        F.count("__y").over(inside).alias("n_inside"))
    value = (F.col("total_before") + F.col("total_inside") + prior_weight * mean) / (F.col("n_before") + F.col("n_inside") + prior_weight)
    found = running.join(shifts, [*group, "block"]).select("__row", "feature", value.alias("value"))
    return _spread(found, rows.drop("__place", "__y"), names)


def apply_target_means(
    df: DataFrame, names: list[str], means: DataFrame, mean: float, prior_weight: float = PRIOR_WEIGHT
) -> DataFrame:
    """The rows with ``<feature>__mean`` from ``means`` (``target_means`` of the training rows); an unseen category has
    the overall ``mean``. Tables of categories are joined, never collected."""
    if not names:
        return df
    rows = _numbered(df)
    long = _categories(rows, ["__row"], names).join(means, ["feature", "category"], "left")
    total, n = (F.coalesce(F.col(c), F.lit(0)) for c in ("total", "n"))
    value = ratio(total + prior_weight * mean, n + F.lit(prior_weight))
    return _spread(long.select("__row", "feature", F.coalesce(value, F.lit(mean)).alias("value")), rows, names)


def encode_splits(split: DataFrame, roles: Roles, names: list[str], seed: int = 42, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """Train rows with ordered means, all others with the means of the train rows, in place of the text features."""
    train = split.filter(F.col("split") == "train")
    rest = split.filter(F.col("split") != "train")
    ready = ordered_target_means(train, names, roles.target, hashed_place(list(roles.ids), seed), prior_weight)
    others = apply_target_means(rest, names, target_means(train, names, roles.target), overall_mean(train, roles.target), prior_weight)
    return ready.unionByName(others).drop(*names)
