"""Drift that is kept up to date: bin counts per month as a table, to which only new rows are added.

The edges and the counts of the training rows are written once. Each batch of rows is counted by itself, under a name
of its own; a batch that is added again replaces its counts, so a repeated delivery changes nothing. The index of all
months comes from the counts alone, however many rows they stand for.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabsift.functions.columns import col
from tabsift.operators.drift import BINS, MIN_MONTH_ROWS, _with_psi, bin_counts, quantile_edges
from tabsift.roles import Roles, month_of

_NAME = re.compile(r"[A-Za-z0-9._-]+")
_COUNTS = "month string, feature string, samples long, n long, counts map<int, long>"


def start(train: DataFrame, roles: Roles, path: str, names: list[str] | None = None, bins: int = BINS) -> None:
    """Write the edges and the training counts of the numeric features: ``feature, edges, n, counts``."""
    names = names if names is not None else roles.numeric(train)
    edges = quantile_edges(train, names, bins)
    spark = train.sparkSession
    listed = spark.createDataFrame([(c, e) for c, e in edges.items()], "feature string, edges array<double>")
    counted = bin_counts(train, [], edges)
    listed.join(counted, "feature", "left").coalesce(1).write.mode("overwrite").parquet(f"{path}/expected")


def _edges(spark: SparkSession, path: str) -> dict[str, list[float]]:
    return {r["feature"]: list(r["edges"]) for r in spark.read.parquet(f"{path}/expected").select("feature", "edges").collect()}


def add(rows: DataFrame, roles: Roles, path: str, batch: str) -> None:
    """Count the rows of a batch by month, feature and bin. A batch of the same name is replaced as a whole."""
    if not _NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits, '.', '_' and '-', not {batch!r}")
    edges = _edges(rows.sparkSession, path)
    dated = rows.filter(col(roles.date).isNotNull()).withColumn("month", month_of(roles.date))
    counted = bin_counts(dated, ["month"], edges)
    sizes = dated.groupBy("month").agg(F.count(F.lit(1)).alias("samples"))
    listed = sizes.withColumn("feature", F.explode(F.array(*(F.lit(c) for c in edges))))
    table = listed.join(counted, ["month", "feature"], "left").select(
        "month", "feature", "samples", "n", F.col("counts").cast("map<int, bigint>").alias("counts"))
    # The folder is renamed into place by Spark's committer: readers see all counts of a batch or none.
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch={batch}")


def current(spark: SparkSession, path: str, min_rows: int = MIN_MONTH_ROWS) -> DataFrame:
    """``month, feature, samples, psi, error`` of all batches so far: what ``monthly_psi`` gives on all their rows."""
    parts = spark.read.schema(f"{_COUNTS}, batch string").option("basePath", f"{path}/counts").parquet(f"{path}/counts")
    sizes = parts.groupBy("month", "feature").agg(F.sum("samples").alias("samples"), F.sum("n").alias("n_a"))
    bins = parts.select("month", "feature", F.explode("counts").alias("bin", "rows")).groupBy("month", "feature", "bin").agg(
        F.sum("rows").alias("rows"))
    maps = bins.groupBy("month", "feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("a"))
    expected = spark.read.parquet(f"{path}/expected").select("feature", F.col("n").alias("n_e"), F.col("counts").alias("e"))
    # One row per feature on one side, per month and feature on the other.
    joined = sizes.join(maps, ["month", "feature"], "left").join(F.broadcast(expected), "feature")
    small = F.col("samples") < min_rows
    return _with_psi(joined, _edges(spark, path), 0.0).select(
        "month", "feature", "samples", F.when(~small, F.col("psi")).alias("psi"),
        F.when(small, F.format_string("Insufficient data (%d samples)", F.col("samples"))).alias("error"))


def batches(spark: SparkSession, path: str) -> DataFrame:
    """``batch, months, rows`` of what has been added."""
    parts = spark.read.schema(f"{_COUNTS}, batch string").option("basePath", f"{path}/counts").parquet(f"{path}/counts")
    by_month = parts.select("batch", "month", "samples").distinct()
    return by_month.groupBy("batch").agg(F.count("month").alias("months"), F.sum("samples").alias("rows"))
