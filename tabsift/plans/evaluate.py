"""All sections of an evaluation, with or without a model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tabsift.functions.columns import col
from tabsift.operators.checks import check_required, monthly_statistics, require
from tabsift.operators.drift import monthly_category_psi, monthly_psi
from tabsift.operators.evaluation import (
    early_vs_latest,
    feature_bins,
    grade_performance,
    monthly_auc,
    score_bins,
)
from tabsift.operators.scoring import score_batch
from tabsift.roles import Roles
from tabsift.session import scratch_path
from tabsift.sources.sinks import read_stage, write_stage

WITHOUT_MODEL = "Basic statistics only - no model predictions available"


def grade_table(spark, train_score: float, oot_score: float, metric: str) -> DataFrame:
    scores = spark.createDataFrame([(float(train_score), float(oot_score))], "train_score double, oot_score double")
    return grade_performance(scores, metric)


def drift_table(train: DataFrame, population: DataFrame, roles: Roles) -> DataFrame:
    """Monthly index of numeric and text features as one table."""
    parts = []
    if any(c in population.columns for c in roles.numeric(train)):
        parts.append(monthly_psi(train, population, roles))
    if any(c in population.columns for c in roles.categorical(train)):
        parts.append(monthly_category_psi(train, population, roles))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def evaluate(
    train: DataFrame,
    population: DataFrame,
    roles: Roles,
    train_score: float,
    oot_score: float,
    metric: str,
    model: PipelineModel | None = None,
    features: list[str] | None = None,
    start: str | None = None,
    end: str | None = None,
    scored: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Section tables by name.

    With a model the rows are scored once, written to the shared folder as a narrow table, and every section reads
    that; ``scored`` (the fixed columns and ``score``) takes its place if the caller has it.
    """
    spark = population.sparkSession
    for df in (train, population):
        require(check_required(df, [roles.date, roles.target]))
    sections = {"performance": grade_table(spark, train_score, oot_score, metric)}
    if model is None and scored is None:
        sections["monthly_statistics"] = monthly_statistics(
            population.filter(col(roles.date).isNotNull()), roles
        ).withColumn("note", F.lit(WITHOUT_MODEL))
        sections["basic_bin_analysis"] = feature_bins(population, roles)
    else:
        if scored is None:
            path = scratch_path(spark, "scored")
            write_stage(score_batch(population, model, features, roles.fixed), path)
            scored = read_stage(spark, path)
        sections["monthly_auc"] = monthly_auc(scored, roles, "score", start, end)
        sections["early_vs_latest_analysis"] = early_vs_latest(scored, roles, "score")
        sections["bin_analysis"] = score_bins(scored, roles, "score")
    sections["psi_analysis"] = drift_table(train, population, roles)
    return sections
