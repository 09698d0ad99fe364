"""Per-feature statistics and the feature quality screen.

Statistics are tables with one row per feature. Data rows are stacked to
(feature, value) and aggregated before any shuffle, so the shuffles carry
features x groups, or distinct categories, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabsift.functions.columns import col, pearson, ratio
from tabsift.functions.pvalues import chi2_sf, f_sf
from tabsift.operators.ranking import stacked
from tabsift.roles import Roles

# Limits of the quality screen.
MAX_MISSING = 0.90
MIN_VALID = 10
MIN_TARGET_CORR = 0.01
MIN_COEF_VARIATION = 0.001
MAX_CARDINALITY = 0.98
QUICK_CATEGORIES = (2, 20)
QUICK_P = 0.2


def settle(table: DataFrame) -> DataFrame:
    """Fix a per-feature table: its rows, bounded by the number of columns, become local data."""
    return table.sparkSession.createDataFrame(table.collect(), table.schema)


def numeric_moments(df: DataFrame, names: list[str], target: str, by: list[str] = []) -> DataFrame:
    """Counts, mean, sample variance, range and target correlation per numeric feature."""
    long = stacked(df, [*by, target], {c: [col(c).cast("double")] for c in names}, ["x"])
    x, y = F.col("x"), col(target).cast("double")
    return (
        long.groupBy(*by, "feature")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(x).alias("n_valid"),
            F.count_if(x.isNotNull() & y.isNotNull()).alias("n_pairs"),
            F.avg(x).alias("mean"),
            F.var_samp(x).alias("variance"),
            F.min(x).alias("min_value"),
            F.max(x).alias("max_value"),
            pearson(x, y).alias("corr"),
        )
        .withColumn("missing_ratio", 1.0 - F.col("n_valid") / F.col("n_rows"))
        .withColumn("constant", F.col("min_value") == F.col("max_value"))
        .withColumn("cv", F.abs(ratio(F.sqrt("variance"), F.col("mean"))))
    )


def anova(moments: DataFrame) -> DataFrame:
    """One-way F statistic of the feature between the two classes, and its p-value.

    With two classes F = r^2 (n - 2) / (1 - r^2).
    """
    r2 = F.col("corr") * F.col("corr")
    stat = ratio(r2 * (F.col("n_pairs") - 2), 1.0 - r2)
    return moments.withColumn("f_stat", stat).withColumn(
        "f_p", f_sf(F.col("f_stat"), F.lit(1.0), F.col("n_pairs") - 2)
    )


def contingency(df: DataFrame, names: list[str], target: str, by_split: bool = False) -> DataFrame:
    """Rows of each (feature, category) by label: ``n0, n1``; a NULL category is one too.

    With ``by_split`` also ``t0, t1`` (train) and ``o0, o1`` (out of time). A
    category that holds most rows is one row per task before the shuffle.
    """
    tag = ["split"] if by_split else []
    long = stacked(df, [*tag, target], {c: [col(c)] for c in names}, ["value"])
    y = col(target)
    if not by_split:
        return long.groupBy("feature", "value").agg(
            F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1")
        )
    parts = long.groupBy("feature", "value").agg(
        *(
            F.count_if((y == c) & (F.col("split") == split)).alias(f"{short}{c}")
            for short, split in (("t", "train"), ("o", "oot"))
            for c in (0, 1)
        )
    )
    return parts.withColumns({f"n{c}": F.col(f"t{c}") + F.col(f"o{c}") for c in (0, 1)})


def chi2_two_columns(table: DataFrame, a: Column, b: Column, yates: bool = True) -> DataFrame:
    """Chi-square of the categories against two count columns, per feature.

    ``feature, n_categories, chi2, dof, p``; NULL when a column or all but one
    category is empty. A 2 x 2 table gets the continuity correction.
    """
    cells = table.select("feature", a.cast("double").alias("a"), b.cast("double").alias("b")).filter(
        F.col("a") + F.col("b") > 0
    )
    # One row per feature: bounded by the number of columns.
    totals = F.broadcast(
        cells.groupBy("feature").agg(
            F.sum("a").alias("all_a"), F.sum("b").alias("all_b"), F.count(F.lit(1)).alias("k")
        )
    )
    size = F.col("a") + F.col("b")
    expected_a = ratio(size * F.col("all_a"), F.col("all_a") + F.col("all_b"))
    expected_b = size - expected_a
    gap = F.abs(F.col("a") - expected_a)
    if yates:
        gap = F.when(F.col("k") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    term = ratio(gap * gap, expected_a) + ratio(gap * gap, expected_b)
    summed = cells.join(totals, "feature").groupBy("feature").agg(
        F.first("k").alias("n_categories"), F.first("all_a").alias("all_a"),
        F.first("all_b").alias("all_b"), F.sum(term).alias("sum"),
    )
    fit = (F.col("n_categories") > 1) & (F.col("all_a") > 0) & (F.col("all_b") > 0)
    return (
        summed.select(
            "feature", "n_categories",
            F.when(fit, F.col("sum")).alias("chi2"),
            F.when(fit, F.col("n_categories") - 1).alias("dof"),
        )
        .withColumn("p", chi2_sf(F.col("chi2"), F.col("dof")))
    )


def mutual_information(table: DataFrame, a: Column, b: Column) -> DataFrame:
    """Plug-in mutual information of category and label in nats: ``feature, mi``.

    N*MI = sum n_xy ln n_xy - sum n_x ln n_x - sum n_y ln n_y + N ln N, so one
    aggregate is enough.
    """
    def xlogx(c: Column) -> Column:
        c = c.cast("double")
        return F.when(c > 0, c * F.ln(c)).otherwise(0.0)

    sums = table.groupBy("feature").agg(
        F.sum(a).alias("a"), F.sum(b).alias("b"),
        F.sum(xlogx(a) + xlogx(b) - xlogx(a + b)).alias("inner"),
    )
    a, b = F.col("a"), F.col("b")
    mi = ratio(F.col("inner") - xlogx(a) - xlogx(b) + xlogx(a + b), (a + b).cast("double"))
    return sums.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))


def cardinality(table: DataFrame) -> DataFrame:
    """Distinct and present values of each text feature, from its contingency table."""
    n = F.col("n0") + F.col("n1")
    present = F.col("value").isNotNull()
    return table.groupBy("feature").agg(
        F.sum(n).alias("n_rows"),
        F.coalesce(F.sum(F.when(present, n)), F.lit(0)).alias("n_valid"),
        F.count_if(present).alias("n_unique"),
    )


def _verdict(rules: list[tuple[Column, bool, Column]]) -> tuple[Column, Column]:
    """First rule that holds decides; none means a plain pass."""
    keep, reason = F.lit(True), F.lit("Pass")
    for when, keeps, text in reversed(rules):
        hit = F.coalesce(when, F.lit(False))
        keep = F.when(hit, F.lit(keeps)).otherwise(keep)
        reason = F.when(hit, text).otherwise(reason)
    return keep, reason


def _too_empty() -> tuple[Column, bool, Column]:
    text = F.format_string("Excessive missing values: %.2f%%", F.col("missing_ratio") * 100.0)
    return F.col("missing_ratio") > MAX_MISSING, False, text


def numeric_quality(moments: DataFrame) -> DataFrame:
    """Screen of numeric features: ``feature, kind, ..., keep, reason``."""
    rules = [
        _too_empty(),
        (F.col("n_valid") < MIN_VALID, False, F.lit("Insufficient valid values")),
        (F.col("constant") | (F.col("variance") == 0), False, F.lit("Zero variance (constant values)")),
        (F.abs("corr") > MIN_TARGET_CORR, True, F.lit("Target correlated")),
        (
            (F.col("mean") != 0) & (F.col("cv") < MIN_COEF_VARIATION), False,
            F.format_string("Very low variability (CV: %.6f)", F.col("cv")),
        ),
    ]
    keep, reason = _verdict(rules)
    return moments.select(
        "feature", F.lit("numeric").alias("kind"), "missing_ratio", "n_valid",
        keep.alias("keep"), reason.alias("reason"),
    )


def categorical_quality(table: DataFrame) -> DataFrame:
    """Screen of text features from their contingency table, missing as NULL."""
    stats = cardinality(table)
    # Blanked, not filtered: a filter would sink below the counting and cost a second pass.
    present = [F.when(F.col("value").isNotNull(), F.col(c)).otherwise(0) for c in ("n0", "n1")]
    low, high = QUICK_CATEGORIES
    quick = chi2_two_columns(table, *present).select("feature", "p")
    joined = stats.join(F.broadcast(quick), "feature", "left").withColumn(
        "missing_ratio", 1.0 - F.col("n_valid") / F.col("n_rows")
    )
    unique = F.col("n_unique")
    rules = [
        _too_empty(),
        (F.col("n_valid") < MIN_VALID, False, F.lit("Insufficient valid values")),
        (unique <= 1, False, F.lit("Single unique value")),
        (
            ratio(unique, F.col("n_valid")) > MAX_CARDINALITY, False,
            F.format_string("High cardinality: %d unique values", unique),
        ),
        (unique.between(low, high) & (F.col("p") < QUICK_P), True, F.lit("Target associated")),
    ]
    keep, reason = _verdict(rules)
    return joined.select(
        "feature", F.lit("categorical").alias("kind"), "missing_ratio", "n_valid",
        keep.alias("keep"), reason.alias("reason"),
    )


def other_quality(df: DataFrame, names: list[str]) -> DataFrame:
    """Dates and other types have only the missing-value rule."""
    long = stacked(df, [], {c: [col(c).isNull()] for c in names}, ["empty"])
    stats = long.groupBy("feature").agg(
        F.avg(F.col("empty").cast("double")).alias("missing_ratio"), F.count_if(~F.col("empty")).alias("n_valid")
    )
    keep, reason = _verdict([_too_empty()])
    return stats.select(
        "feature", F.lit("other").alias("kind"), "missing_ratio", "n_valid",
        keep.alias("keep"), reason.alias("reason"),
    )


def quality_verdict(df: DataFrame, roles: Roles) -> DataFrame:
    """Keep or drop every feature, with the reason: ``feature, kind, missing_ratio,
    n_valid, keep, reason``."""
    parts = []
    if names := roles.numeric(df):
        parts.append(numeric_quality(numeric_moments(df, names, roles.target)))
    if names := roles.categorical(df):
        parts.append(categorical_quality(contingency(df, names, roles.target)))
    if names := roles.other(df):
        parts.append(other_quality(df, names))
    if not parts:
        raise ValueError("the table has no feature columns")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
