"""Significance score of many features, an optional step after the screen."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabsift.operators.profile import (
    anova,
    chi2_two_columns,
    contingency,
    mutual_information,
    numeric_moments,
)
from tabsift.operators.ranking import rank_sums, spearman_of
from tabsift.roles import Roles

# Weights and limits of the score.
PEARSON_WEIGHT = 10.0
SPEARMAN_WEIGHT = 8.0
ANOVA_BONUS = 5.0
ANOVA_P = 0.05
CHI2_BONUS = [(0.05, 8.0), (0.1, 4.0)]
MI_WEIGHT = 20.0
MIN_SCORE = 0.05


def spearman(df: DataFrame, names: list[str], target: str, by: list[str] = []) -> DataFrame:
    """Rank correlation with the target per feature (and group)."""
    sums = rank_sums(df, by, names, target)
    rho = spearman_of(*(F.col(c) for c in ("n", "p", "positive_rank_sum", "rank_square_sum")))
    return sums.select(*by, "feature", F.col("n").alias("n_valid"), rho.alias("rho"))


def numeric_significance(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """``feature, score`` of numeric features without missing values."""
    stats = anova(numeric_moments(df, names, target)).select("feature", "corr", "f_stat", "f_p")
    joined = stats.join(F.broadcast(spearman(df, names, target).select("feature", "rho")), "feature", "left")
    score = (
        F.coalesce(F.abs("corr") * PEARSON_WEIGHT, F.lit(0.0))
        + F.coalesce(F.abs("rho") * SPEARMAN_WEIGHT, F.lit(0.0))
        + F.when(F.col("f_p") < ANOVA_P, ANOVA_BONUS).otherwise(0.0)
    )
    return joined.select("feature", score.alias("score"))


def categorical_significance(df: DataFrame, names: list[str], target: str) -> DataFrame:
    """``feature, score`` of text features; missing is a category of its own."""
    table = contingency(df, names, target)
    n0, n1 = F.col("n0"), F.col("n1")
    joined = chi2_two_columns(table, n0, n1).join(
        F.broadcast(mutual_information(table, n0, n1)), "feature"
    )
    bonus = F.lit(0.0)
    for p, points in reversed(CHI2_BONUS):
        bonus = F.when(F.col("p") < p, points).otherwise(bonus)
    return joined.select("feature", (bonus + F.col("mi") * MI_WEIGHT).alias("score"))


def significance_score(df: DataFrame, roles: Roles, names: list[str] | None = None) -> DataFrame:
    """Scores of all features (or of ``names``)."""
    chosen = set(names if names is not None else roles.features(df))
    parts = []
    if numeric := [c for c in roles.numeric(df) if c in chosen]:
        parts.append(numeric_significance(df, numeric, roles.target))
    if text := [c for c in roles.categorical(df) if c in chosen]:
        parts.append(categorical_significance(df, text, roles.target))
    if not parts:
        raise ValueError("no numeric or text features to score")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def significance_filter(scores: DataFrame, top: int | None = None) -> DataFrame:
    """The features with a score above the limit; only the ``top`` ones if given, ties by name."""
    found = scores.filter(F.col("score") > MIN_SCORE)
    return found if top is None else found.orderBy(F.desc("score"), "feature").limit(top)
