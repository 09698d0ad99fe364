"""Target relationship, ranking and selection of features.

The statistics come from whole-table jobs; from there on every rule works on a
table with one row per feature.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tabsift.functions.columns import col
from tabsift.operators.encoding import SUFFIX, hashed_place, ordered_target_means
from tabsift.operators.profile import (
    chi2_two_columns,
    contingency,
    mutual_information,
    numeric_moments,
)
from tabsift.operators.significance import spearman
from tabsift.operators.training import feature_stages, tree_bins
from tabsift.roles import Roles

# Weights and limits.
SPEARMAN_FACTOR = 0.8
MI_FACTOR = 2.0
CHI2_SCORE = 0.1
CHI2_P = 0.05
MIN_TARGET_SCORE = 0.01
FOREST = {"numTrees": 20, "maxDepth": 6, "seed": 42}
STATISTIC_SHARE, FOREST_SHARE = 0.6, 0.4
SCORE_FLOOR = 0.001
STABLE_PSI, MODERATE_PSI = 0.4, 1.0
STABLE_P = 0.01
QUICK_MAX_MISSING = 0.8
BOOSTED = {"maxIter": 3, "maxDepth": 4, "stepSize": 0.2, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.6", "seed": 42}


def _by_split(table: DataFrame, value: str) -> DataFrame:
    return table.groupBy("feature").agg(
        *(F.max(F.when(F.col("split") == s, F.abs(value))).alias(f"{value}_{s}") for s in ("train", "oot"))
    )


def numeric_relationship(split: DataFrame, names: list[str], target: str, use_oot_labels: bool = True) -> DataFrame:
    """``feature, avg_pearson, avg_spearman, point_biserial, target_score``.

    The averages are over train and out-of-time; without out-of-time labels they
    are the train values.
    """
    rows = split if use_oot_labels else split.filter(F.col("split") == "train")
    moments = numeric_moments(rows, names, target, ["split"])
    r = _by_split(moments, "corr")
    rho = _by_split(spearman(rows, names, target, ["split"]), "rho")
    both = r.join(F.broadcast(rho), "feature", "left")

    def average(value: str):
        train, oot = F.col(f"{value}_train"), F.col(f"{value}_oot")
        return (train + oot) / 2.0 if use_oot_labels else train

    return both.select(
        "feature",
        average("corr").alias("avg_pearson"),
        (average("rho") * SPEARMAN_FACTOR).alias("avg_spearman"),
        F.col("corr_train").alias("point_biserial"),
    ).withColumn("target_score", F.greatest("avg_pearson", "avg_spearman", "point_biserial"))


def categorical_relationship(split: DataFrame, names: list[str], target: str) -> DataFrame:
    """``feature, mi, chi2_p, target_score`` on training rows; missing is a category."""
    table = contingency(split.filter(F.col("split") == "train"), names, target)
    n0, n1 = F.col("n0"), F.col("n1")
    joined = mutual_information(table, n0, n1).join(
        F.broadcast(chi2_two_columns(table, n0, n1).select("feature", F.col("p").alias("chi2_p"))), "feature"
    )
    bonus = F.when(F.col("chi2_p") < CHI2_P, CHI2_SCORE)
    return joined.withColumn("target_score", F.greatest(F.col("mi") * MI_FACTOR, bonus))


def combined_score(stability: DataFrame, relationship: DataFrame) -> DataFrame:
    """``feature, kind, stability, target_score, score`` of related features.

    ``stability``: ``feature, kind, stability`` (index for numbers, p-value for text).
    Features on one side only drop out.
    """
    t, s = F.col("target_score"), F.col("stability")
    score = F.when(F.col("kind") == "numeric", t * (2.0 / (1.0 + s))).otherwise(
        t * F.least(s * 2.0, F.lit(1.0))
    )
    return (
        stability.join(F.broadcast(relationship.select("feature", "target_score")), "feature")
        .filter(t > MIN_TARGET_SCORE)
        .select("feature", "kind", "stability", "target_score", score.alias("score"))
    )


def _importances(model, features: list[str], spark) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double")


def _learned_rows(split: DataFrame, names: list[str], target: str, order_by: list[str] | None) -> tuple[DataFrame, list[str]]:
    """Training rows and the columns that stand for ``names``; with ``order_by`` text features are ordered target means."""
    rows = split.filter(F.col("split") == "train")
    inputs = list(names)
    if order_by:
        text = [c for c in names if isinstance(split.schema[c].dataType, T.StringType)]
        rows = ordered_target_means(rows, text, target, hashed_place(order_by))
        inputs = [f"{c}{SUFFIX}" if c in text else c for c in names]
    return rows.select(*(col(c) for c in inputs), col(target).cast("double").alias("label__")), inputs


def _fitted(rows: DataFrame, inputs: list[str], trees) -> PipelineModel:
    """The trees fitted to the rows, which are kept meanwhile: a fit passes over them several times."""
    kept = rows.persist()
    try:
        return Pipeline(stages=[*feature_stages(kept, inputs), trees.setMaxBins(tree_bins(kept, inputs))]).fit(kept)
    finally:
        kept.unpersist()


def forest_importance(split: DataFrame, names: list[str], target: str, order_by: list[str] | None = None) -> DataFrame:
    """Importance of each feature in a small random forest on the training rows.

    Text features are indexed, which puts their categories on the driver; with ``order_by`` (the ids) they are target means
    of the rows before in a hashed order instead, for any number of categories.
    """
    rows, inputs = _learned_rows(split, names, target, order_by)
    model = _fitted(rows, inputs, RandomForestClassifier(labelCol="label__", **FOREST))
    return _importances(model, names, split.sparkSession)


def join_importance(scores: DataFrame, importance: DataFrame) -> DataFrame:
    """Blend statistical score and importance; a feature without importance has importance 0."""
    blended = F.col("score") * STATISTIC_SHARE + F.coalesce("importance", F.lit(0.0)) * FOREST_SHARE
    return scores.join(importance, "feature", "left").withColumn("score", blended).drop("importance")


def forest_blend(scores: DataFrame, split: DataFrame, target: str) -> DataFrame:
    """Blend in the forest importance of all features that have a score."""
    names = [r["feature"] for r in scores.select("feature").orderBy("feature").collect()]
    return join_importance(scores, forest_importance(split, names, target)) if names else scores


def score_threshold(scores: DataFrame) -> DataFrame:
    """Add ``score_mean`` and ``min_score``: two deviations below the mean, or the floor."""
    whole = Window.partitionBy(F.lit(1))  # one row per feature
    return scores.withColumn("score_mean", F.avg("score").over(whole)).withColumn(
        "min_score",
        F.greatest(F.lit(SCORE_FLOOR), F.col("score_mean") - 2.0 * F.stddev_pop("score").over(whole)),
    )


def stability_tier(scores: DataFrame) -> DataFrame:
    """Add ``tier``: high, moderate, or NULL for features below the threshold."""
    s, numeric = F.col("stability"), F.col("kind") == "numeric"
    tier = (
        F.when(s.isNull(), F.when(F.col("score") > F.col("score_mean"), "moderate"))
        .when(numeric & (s < STABLE_PSI), "high")
        .when(numeric, F.when(s < MODERATE_PSI, "moderate"))
        .when(s > STABLE_P, "high")
        .otherwise("moderate")
    )
    return score_threshold(scores).withColumn("tier", F.when(F.col("score") > F.col("min_score"), tier))


def rank_selected(scores: DataFrame, most: int | None = None, fill_to: int = 0) -> DataFrame:
    """``feature, kind, stability, score, tier, selected, rank``.

    High tier first, then moderate, each by score. Where fewer than ``fill_to`` features have a tier, others with a
    positive score follow by score up to that number (default: none). Only the first ``most`` are selected if given.
    """
    tiers = stability_tier(scores)
    whole = Window.partitionBy(F.lit(1))  # one row per feature
    by_score = whole.orderBy(F.desc("score"), "feature")
    place = F.when(F.col("tier") == "high", 0).when(F.col("tier") == "moderate", 1).otherwise(2)
    marked = (
        tiers.withColumn("__place", place)
        .withColumn("__sure", F.count("tier").over(whole))
        .withColumn("__extra", F.sum(F.when(F.col("tier").isNull() & (F.col("score") > 0), 1)).over(by_score))
    )
    fill = F.col("tier").isNull() & (F.col("score") > 0) & (F.col("__extra") <= F.lit(fill_to) - F.col("__sure"))
    chosen = marked.withColumn("__in", F.col("tier").isNotNull() | fill)
    order = Window.partitionBy("__in").orderBy("__place", F.desc("score"), "feature")
    chosen = chosen.withColumn("__rank", F.row_number().over(order))
    within = F.lit(True) if most is None else F.col("__rank") <= most
    chosen = chosen.withColumn("selected", F.col("__in") & within)
    return chosen.withColumn("rank", F.when(F.col("selected"), F.col("__rank"))).select(
        "feature", "kind", "stability", "score", "tier", "selected", "rank"
    )


def top_features(ranked: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` features by score with their verdict."""
    return (
        ranked.orderBy(F.desc("score"), "feature")
        .limit(n)
        .select(
            "feature", "kind", "score",
            F.when(F.col("selected"), "SELECTED").otherwise("REJECTED").alias("status"),
        )
    )


def quick_filter(split: DataFrame, roles: Roles) -> DataFrame:
    """Numeric features with under 80 percent missing and some variance, from training rows."""
    rows = split.filter(F.col("split") == "train") if "split" in split.columns else split
    moments = numeric_moments(rows, roles.numeric(rows), roles.target)
    fit = (F.col("missing_ratio") < QUICK_MAX_MISSING) & (F.col("variance") > 0) & ~F.col("constant")
    return moments.filter(fit).select("feature", "missing_ratio", "variance")


def boosted_importance(
    split: DataFrame, names: list[str], target: str, most: int | None = None, order_by: list[str] | None = None
) -> DataFrame:
    """Fallback ranking by a three-round boosted model: ``feature, importance``, positive only, best first; only
    the first ``most`` if given. ``order_by`` as in ``forest_importance``."""
    rows, inputs = _learned_rows(split, names, target, order_by)
    model = _fitted(rows, inputs, GBTClassifier(labelCol="label__", **BOOSTED))
    found = _importances(model, names, split.sparkSession)
    ranked = found.filter(F.col("importance") > 0).orderBy(F.desc("importance"), "feature")
    return ranked if most is None else ranked.limit(most)

