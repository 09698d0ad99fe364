"""Evaluation of scores: area under the curve, bins, grades, agreement."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tabsift.functions.columns import closed_right_bin, col, linear_probs, ratio, round_half_even
from tabsift.operators.ranking import auc_of, average_precision, exact_quantiles, rank_sums, stacked
from tabsift.roles import Roles, month_of, within
from tabsift.sources.sinks import measured

# Groups of so many rows or fewer get no figures, unless the caller names another size.
MORE_THAN_ROWS = 10
# Texts of the reports.
NO_AUC = "Insufficient data or no label variance"
NO_BINS = "Insufficient data for binning"
NO_EDGES = "All values equal: no bin edges"
NO_PERIODS = "Need at least 2 months for early vs latest analysis"
# Grade bands, strict lower limits from best to worst.
BANDS = {
    "AUC": (0.8, 0.7, 0.6),
    "AUCPR": (0.8, 0.7, 0.6),
    "F1": (0.75, 0.65, 0.55),
    "OTHER": (0.85, 0.75, 0.65),
}
LEVELS = (
    "Model performs excellently",
    "Model performs well",
    "Model performs adequately",
    "Model needs improvement",
)
GAP_BANDS = (0.15, 0.1, 0.05)
GAP_LEVELS = (
    "severe overfitting detected",
    "significant overfitting",
    "mild overfitting",
    "acceptable generalization",
)


def auc(df: DataFrame, score: str, label: str, by: list[str] = []) -> DataFrame:
    """``by, samples, positive_count, positive_rate, auc``; rows without score or label do not count."""
    n, p = F.col("n"), F.col("p")
    return rank_sums(df, by, [score], label).select(
        *by, n.alias("samples"), p.alias("positive_count"),
        ratio(p.cast("double"), n.cast("double")).alias("positive_rate"),
        auc_of(n, p, F.col("positive_rank_sum")).alias("auc"),
    )


def average_precision_by(df: DataFrame, score: str, label: str, by: list[str] = []) -> DataFrame:
    """``by, samples, positive_count, average_precision``."""
    return average_precision(df, by, score, label)


def f1_score(df: DataFrame, score: str, label: str, by: list[str] = [], threshold: float = 0.5) -> DataFrame:
    """F1 of the decision ``score >= threshold``: ``by, f1``."""
    hit, positive = col(score) >= threshold, col(label) == 1
    found = df.groupBy(*by).agg(
        F.count_if(hit & positive).alias("tp"), F.count_if(hit).alias("hits"), F.count_if(positive).alias("positives")
    )
    return found.select(
        *by, ratio(2.0 * F.col("tp"), (F.col("hits") + F.col("positives")).cast("double")).alias("f1")
    )


def _judged(table: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    """Withhold the area of groups that are too small or have one label value; their counts stay."""
    n, p = F.col("samples"), F.col("positive_count")
    fit = (n > more_than) & (p > 0) & (p < n)
    return table.select(
        *keys, F.when(fit, F.col("auc")).alias("auc"), "samples", "positive_count", "positive_rate",
        F.when(~fit, NO_AUC).alias("error"),
    )


def monthly_auc(
    df: DataFrame, roles: Roles, score: str, start: str | None = None, end: str | None = None,
    more_than: int = MORE_THAN_ROWS,
) -> DataFrame:
    """AUC of every month of more than ``more_than`` rows, in one job: ``month, auc, samples, positive_count,
    positive_rate, error``."""
    rows = df if start is None else df.filter(within(df, roles.date, start, end))
    dated = rows.filter(col(roles.date).isNotNull()).withColumn("month", month_of(roles.date))
    return _judged(auc(dated, score, roles.target, ["month"]), ["month"], more_than)


def month_periods(dated: DataFrame) -> DataFrame:
    """``month, period``: the earlier half of the months (rounded down) and the rest."""
    months = dated.select("month").distinct()
    whole = Window.partitionBy(F.lit(1))  # one row per month
    n = F.count(F.lit(1)).over(whole)
    place = F.row_number().over(whole.orderBy("month"))
    period = F.when(n < 2, "all").when(place <= F.floor(n / 2), "early").otherwise("latest")
    return months.select("month", period.alias("period"))


def early_vs_latest(df: DataFrame, roles: Roles, score: str, more_than: int = MORE_THAN_ROWS) -> DataFrame:
    """AUC of the earlier and the later half of the months.

    ``period, auc, samples, positive_count, positive_rate, months, error``.
    """
    dated = df.filter(col(roles.date).isNotNull()).withColumn("month", month_of(roles.date))
    periods = month_periods(dated)
    judged = _judged(
        auc(dated.join(F.broadcast(periods), "month"), score, roles.target, ["period"]), ["period"], more_than
    )
    lists = periods.groupBy("period").agg(F.array_sort(F.collect_list("month")).alias("months"))
    single = F.col("period") == "all"
    return judged.join(F.broadcast(lists), "period").select(
        "period", F.when(~single, F.col("auc")).alias("auc"), "samples", "positive_count", "positive_rate", "months",
        F.when(single, NO_PERIODS).otherwise(F.col("error")).alias("error"),
    )


def _percent(part, whole):
    return round_half_even(ratio(part.cast("double"), whole.cast("double")) * 100.0)


def _binned(long: DataFrame, keys: list[str], bins: int, more_than: int) -> DataFrame:
    """Per key, bins of ``s`` between its distinct quantiles, right ends closed, with totals of the key.

    ``long``: ``keys, y, s``. Rows without a value are in no bin; ``missing`` counts them per key.
    """
    named = long.withColumn("y", F.col("y").cast("bigint"))
    edges = exact_quantiles(named, keys, ["s"], linear_probs(bins)).select(
        *keys, F.array_distinct("quantiles").alias("edges")
    )
    # One row per key on the right; Spark picks the join by its measured size.
    placed = named.join(measured(edges, "edges"), keys, "left").withColumn("s", F.nullif(F.col("s"), F.lit(float("nan"))))
    in_bin = placed.groupBy(
        *keys, F.col("s").isNull().alias("absent"), closed_right_bin(F.col("s"), F.col("edges"), bins + 1).alias("bin")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("p"),
        F.min("s").alias("lo"), F.max("s").alias("hi"), F.sum("s").alias("t"),
    )
    whole = Window.partitionBy(*keys)
    here = ~F.col("absent")
    totals = in_bin.select(
        "*",
        F.coalesce(F.sum(F.when(here, F.col("n"))).over(whole), F.lit(0)).alias("total_population"),
        F.coalesce(F.sum(F.when(here, F.col("p"))).over(whole), F.lit(0)).alias("total_positive"),
        F.coalesce(F.sum(F.when(F.col("absent"), F.col("n"))).over(whole), F.lit(0)).alias("missing"),
        F.max("bin").over(whole).isNull().alias("flat"),
        F.row_number().over(whole.orderBy(F.col("absent"), F.col("bin").asc_nulls_last())).alias("turn"),
    )
    error = F.when(F.col("total_population") <= more_than, NO_BINS).when(F.col("flat"), NO_EDGES)
    n, p = F.col("n"), F.col("p")
    figures = {
        "bin": F.col("bin"), "count_population": n, "count_positive": p,
        "pct_distribution": _percent(n, F.col("total_population")), "positive_rate": _percent(p, n),
        "score_min": F.col("lo"), "score_max": F.col("hi"), "score_mean": ratio(F.col("t"), n.cast("double")),
    }
    judged = totals.withColumn("error", error)
    ok = F.col("error").isNull()
    # A key without bins keeps one row, with its totals.
    return judged.filter((ok & here) | (~ok & (F.col("turn") == 1))).select(
        *keys, *(F.when(ok, c).alias(k) for k, c in figures.items()), "total_population", "total_positive",
        _percent(F.col("total_positive"), F.col("total_population")).alias("overall_positive_rate"), "missing", "error",
    )


def score_bins(df: DataFrame, roles: Roles, score: str, bins: int = 10, more_than: int = MORE_THAN_ROWS) -> DataFrame:
    """Per month, bins of the score between its distinct quantiles, right ends closed.

    ``month, bin, count_population, count_positive, pct_distribution, positive_rate,
    score_min, score_max, score_mean``, the month's totals and ``missing``, its rows without a score, which are in
    no bin; ``error`` instead of bins for months of ``more_than`` scores or fewer, or with a single score. Equal
    scores share a bin.
    """
    dated = df.filter(col(roles.date).isNotNull()).select(
        month_of(roles.date).alias("month"), col(roles.target).alias("y"), col(score).cast("double").alias("s")
    )
    return _binned(dated, ["month"], bins, more_than)


def feature_bins(
    df: DataFrame, roles: Roles, names: list[str] | None = None, bins: int = 5, more_than: int = MORE_THAN_ROWS
) -> DataFrame:
    """Bins of all (or the named) features, for evaluation without a model.

    ``month, feature, category`` and the columns of ``score_bins``. A numeric feature has bins, a text feature one
    row per category (NULL for missing text).
    """
    chosen = names if names is not None else roles.features(df)
    dated = df.filter(col(roles.date).isNotNull()).withColumn("month__", month_of(roles.date))
    key = [F.col("month__").alias("month")]
    parts = []
    if numeric := [c for c in roles.numeric(df) if c in chosen]:
        long = stacked(dated, ["month__", roles.target], {c: [col(c).cast("double")] for c in numeric}, ["s"])
        long = long.select(*key, F.col("feature").alias("name"), col(roles.target).alias("y"), "s")
        binned = _binned(long, ["month", "name"], bins, more_than).withColumnRenamed("name", "feature")
        parts.append(binned.withColumn("category", F.lit(None).cast("string")))
    if text := [c for c in roles.categorical(df) if c in chosen]:
        long = stacked(dated, ["month__", roles.target], {c: [col(c)] for c in text}, ["category"])
        counted = long.groupBy(*key, "feature", "category").agg(
            F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(col(roles.target).cast("bigint")), F.lit(0)).alias("p"))
        whole = Window.partitionBy("month", "feature")
        n, p = F.col("n"), F.col("p")
        total, positive = F.sum("n").over(whole), F.sum("p").over(whole)
        none = F.lit(None).cast("double")
        parts.append(counted.select(
            "month", "feature", F.lit(None).cast("int").alias("bin"), n.alias("count_population"),
            p.alias("count_positive"), _percent(n, total).alias("pct_distribution"), _percent(p, n).alias("positive_rate"),
            none.alias("score_min"), none.alias("score_max"), none.alias("score_mean"),
            total.alias("total_population"), positive.alias("total_positive"),
            _percent(positive, total).alias("overall_positive_rate"),
            F.coalesce(F.sum(F.when(F.col("category").isNull(), n)).over(whole), F.lit(0)).alias("missing"),
            F.lit(None).cast("string").alias("error"), "category",
        ))
    if not parts:
        raise ValueError("no numeric or text features to bin")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _band(value, limits, levels):
    out = F.lit(levels[-1])
    for limit, level in reversed(list(zip(limits, levels))):
        out = F.when(value > limit, level).otherwise(out)
    return out


def grade_performance(scores: DataFrame, metric: str) -> DataFrame:
    """Grade rows with ``train_score`` and ``oot_score`` by the bands of the metric.

    Adds ``overfitting, performance_level, overfitting_level, status`` and
    ``deployable``: at least adequate, and no more than mild overfitting.
    """
    limits = BANDS.get(metric.upper(), BANDS["OTHER"])
    gap = F.col("train_score") - F.col("oot_score")
    return (
        scores.withColumn("overfitting", gap)
        .withColumn("performance_level", _band(F.col("oot_score"), limits, LEVELS))
        .withColumn("overfitting_level", _band(F.col("overfitting"), GAP_BANDS, GAP_LEVELS))
        .withColumn("status", F.concat_ws(", ", "performance_level", "overfitting_level"))
        .withColumn("deployable", (F.col("oot_score") > limits[2]) & (F.col("overfitting") <= GAP_BANDS[1]))
    )


def reconcile_scores(a: DataFrame, b: DataFrame, ids: list[str], score: str = "score", tolerance: float = 1e-6) -> DataFrame:
    """Compare the scores two systems gave the same ids.

    ``matched, mismatched, only_a, only_b, max_abs_diff`` over ids. Each side is
    reduced to one row per id before the join; an id with repeated scores matches
    if every pair of its scores does, which its least and greatest score decide.
    Missing scores never match.
    """
    def side(df: DataFrame, s: str) -> DataFrame:
        return df.groupBy(*ids).agg(
            F.min(score).alias(f"{s}_lo"), F.max(score).alias(f"{s}_hi"),
            F.count_if(col(score).isNull()).alias(f"{s}_nulls"), F.lit(True).alias(f"in_{s}"),
        )

    both = side(a, "a").join(side(b, "b"), ids, "full_outer")
    paired = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    gap = F.greatest(F.col("a_hi") - F.col("b_lo"), F.col("b_hi") - F.col("a_lo"))
    same = F.coalesce((F.col("a_nulls") + F.col("b_nulls") == 0) & (gap <= tolerance), F.lit(False))
    return both.agg(
        F.count_if(paired & same).alias("matched"),
        F.count_if(paired & ~same).alias("mismatched"),
        F.count_if(F.col("in_b").isNull()).alias("only_a"),
        F.count_if(F.col("in_a").isNull()).alias("only_b"),
        F.max(F.when(paired, gap)).alias("max_abs_diff"),
    )
