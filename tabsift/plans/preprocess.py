"""From a wide table to checked, cleaned, split rows and a list of features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tabsift.operators.checks import data_checks, require
from tabsift.operators.cleaning import (
    drop_constant,
    fill_sentinel,
    impute_median,
    keep_features,
    round_features,
    select_roles,
    to_datetime,
)
from tabsift.operators.drift import categorical_stability, numeric_stability
from tabsift.operators.profile import quality_verdict, settle
from tabsift.operators.selection import (
    boosted_importance,
    categorical_relationship,
    combined_score,
    forest_blend,
    numeric_relationship,
    quick_filter,
    rank_selected,
)
from tabsift.operators.significance import significance_filter, significance_score
from tabsift.operators.splitting import split_by_date
from tabsift.roles import Roles, Windows
from tabsift.sources.sinks import feature_report, read_stage, write_stage
from tabsift.sources.tables import nan_to_null


@dataclass(frozen=True)
class SelectionOptions:
    """``screen_on``: judge missing values on "raw" or "filled" rows.
    ``stats_on``: statistics on "filled" rows, or on "imputed" ones (medians per split).
    ``use_oot_labels``: whether out-of-time labels take part in the choice.
    ``significant``: keep only so many features by significance after the screen; None keeps all, 0 keeps all that
    have any. ``max_categories``: text features of more categories are out. ``forest``: blend in the importance of a
    forest. ``most``: select only so many. ``fill_to``: where fewer have a tier, fill up to so many by score.
    No step depends on the number of features unless these say so.
    ``on_empty``: "error" or "fallback" (boosted importance) if nothing is selected."""

    screen_on: str = "raw"
    stats_on: str = "filled"
    use_oot_labels: bool = True
    significant: int | None = None
    max_categories: int | None = None
    forest: bool = False
    most: int | None = None
    fill_to: int = 0
    on_empty: str = "error"

    def __post_init__(self):
        if self.on_empty not in ("error", "fallback"):
            raise ValueError(f"on_empty must be 'error' or 'fallback', not {self.on_empty!r}")


@dataclass
class Splits:
    """The split table before and after filling; same rows and columns."""

    raw: DataFrame
    filled: DataFrame


def with_filled(raw: DataFrame, roles: Roles) -> Splits:
    """Fill and round are projections of the split rows; they cost no pass of their own."""
    return Splits(raw, round_features(fill_sentinel(raw, roles), roles))


def prepare(df: DataFrame, roles: Roles, windows: Windows) -> Splits:
    """Keep the roles, drop constants, split, fill and round."""
    chosen = drop_constant(to_datetime(select_roles(df, roles), roles.date), roles)
    return with_filled(split_by_date(chosen, roles.date, windows), roles)


def stage(splits: Splits, roles: Roles, path: str) -> Splits:
    """Write the split rows once, so that later passes read columns and not their source."""
    write_stage(splits.raw, path)
    return with_filled(read_stage(splits.raw.sparkSession, path), roles)


def _labelled(split: DataFrame, options: SelectionOptions) -> DataFrame:
    return split if options.use_oot_labels else split.filter(F.col("split") == "train")


def screened(splits: Splits, roles: Roles, options: SelectionOptions = SelectionOptions()) -> list[str]:
    """Names of the features that pass the quality screen (and the significance step, if asked for), in table order."""
    rows = splits.raw if options.screen_on == "raw" else splits.filled
    verdict = quality_verdict(_labelled(rows, options), roles)
    kept = {r["feature"] for r in verdict.filter("keep").select("feature").collect()}
    names = [c for c in roles.features(splits.filled) if c in kept]
    if options.significant is not None and names:
        scores = significance_score(_labelled(splits.filled, options), roles, names)
        kept = {r["feature"] for r in significance_filter(scores, options.significant or None).collect()}
        names = [c for c in names if c in kept]
    return names


def stability(split: DataFrame, roles: Roles, names: list[str], options: SelectionOptions) -> DataFrame:
    """``feature, kind, stability, keep`` of the given features."""
    numeric = [c for c in roles.numeric(split) if c in names]
    text = [c for c in roles.categorical(split) if c in names]
    parts = []
    if numeric:
        parts.append(
            numeric_stability(split, roles, numeric, _labelled(split, options))
            .select("feature", F.lit("numeric").alias("kind"), "stability", "keep")
        )
    if text:
        parts.append(
            categorical_stability(split, roles, text, options.use_oot_labels, options.max_categories)
            .select("feature", F.lit("categorical").alias("kind"), "stability", "keep")
        )
    if not parts:
        return split.sparkSession.createDataFrame([], "feature string, kind string, stability double, keep boolean")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def relationship(split: DataFrame, roles: Roles, stable: DataFrame, options: SelectionOptions) -> DataFrame:
    """``feature, target_score`` of stable features; ``stable`` is a settled table."""
    kinds = {r["feature"]: r["kind"] for r in stable.collect()}
    numeric = [c for c in roles.numeric(split) if kinds.get(c) == "numeric"]
    text = [c for c in roles.categorical(split) if kinds.get(c) == "categorical"]
    parts = []
    if numeric:
        parts.append(numeric_relationship(split, numeric, roles.target, options.use_oot_labels))
    if text:
        parts.append(categorical_relationship(split, text, roles.target))
    parts = [p.select("feature", "target_score") for p in parts]
    if not parts:
        return split.sparkSession.createDataFrame([], "feature string, target_score double")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def feature_scores(splits: Splits, roles: Roles, options: SelectionOptions = SelectionOptions()) -> DataFrame:
    """``feature, kind, stability, target_score, score`` of features that pass every screen.

    Each screen runs only over the columns the one before left. What passes between
    them is one row per feature.
    """
    names = screened(splits, roles, options)
    split = splits.filled
    if options.stats_on == "imputed":
        numeric = [c for c in roles.numeric(splits.raw) if c in names]
        split = impute_median(splits.raw, numeric) if numeric else splits.raw
    stable = settle(stability(split, roles, names, options).filter("keep").drop("keep"))
    related = settle(relationship(split, roles, stable, options))
    return combined_score(stable, related)


def select_features(splits: Splits, roles: Roles, options: SelectionOptions = SelectionOptions()) -> DataFrame:
    """``feature, kind, stability, score, tier, selected, rank``."""
    scores = settle(feature_scores(splits, roles, options))
    if options.forest:
        scores = forest_blend(scores, splits.filled, roles.target)
    return rank_selected(scores, options.most, options.fill_to)


def fallback_features(split: DataFrame, roles: Roles) -> list[str]:
    """Features by boosted importance, best first; numeric ones with some variance only."""
    fit = {r["feature"] for r in quick_filter(split, roles).collect()}
    names = [c for c in roles.numeric(split) if c in fit]
    if not names:
        return []
    return [r["feature"] for r in boosted_importance(split, names, roles.target).collect()]


@dataclass
class Prepared:
    """Checked and reduced rows, the ranking, the feature names in order, and where they come from: "selection" or
    "fallback"."""

    split: DataFrame
    ranking: DataFrame
    features: list[str]
    report: DataFrame
    source: str = "selection"


def preprocess(
    df: DataFrame, roles: Roles, windows: Windows, path: str, options: SelectionOptions = SelectionOptions()
) -> Prepared:
    """The whole step: check, clean, split, select, with the split rows written to ``path``.

    The split table is written once, partitioned by split, and the statistics read it
    back; the many passes do not repeat what lies before it.
    """
    df = nan_to_null(df)
    require(data_checks(to_datetime(df, roles.date), roles, windows))
    splits = stage(prepare(df, roles, windows), roles, path)
    ranking = settle(select_features(splits, roles, options))
    features = [r["feature"] for r in ranking.filter("selected").orderBy("rank").collect()]
    source = "selection"
    if not features and options.on_empty == "fallback":
        features, source = fallback_features(splits.filled, roles), "fallback"
        ranking = settle(fallback_ranking(splits.filled.sparkSession, features))
    if not features:
        raise ValueError(f"no feature is left after the screens and the {source}: see the ranking and quality tables")
    kept = keep_features(splits.filled, roles, features)
    return Prepared(kept, ranking, features, feature_report(ranking.filter("selected"), kept), source)


def fallback_ranking(spark, features: list[str]) -> DataFrame:
    """The fallback's features in the columns of ``select_features``, in their order."""
    rows = [(c, "numeric", None, None, "fallback", True, i + 1) for i, c in enumerate(features)]
    return spark.createDataFrame(
        rows, "feature string, kind string, stability double, score double, tier string, selected boolean, rank int")
