"""Drift between periods: population stability index and category shares."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tabsift.functions.columns import col, linear_probs, ratio
from tabsift.operators.profile import chi2_two_columns, contingency, mutual_information, numeric_moments
from tabsift.operators.ranking import cut_stacked, exact_quantiles, stacked
from tabsift.roles import Roles

# Fixed values of the index.
BINS = 10
MIN_VALUES = 10
MIN_EDGES = 3
COUNT_PAD = 1e-8
TOTAL_PAD = 1e-7
PSI_CAP = 10.0
# Limits of the stability screen.
STABLE_PSI = 0.4
UNSTABLE_PSI = 1.0
MODERATE_MIN_CORR = 0.05
MIN_CATEGORIES = 2
STABLE_P = 0.01
MIN_MI = 0.05
# Smallest month that is compared, unless the caller names another size.
MIN_MONTH_ROWS = 50

INFINITE = float("inf")


def quantile_edges(expected: DataFrame, names: list[str], bins: int = BINS) -> dict[str, list[float]]:
    """Distinct bin edges per feature from the expected rows, exact.

    They are read to the driver: ``bins + 1`` numbers per feature.
    """
    found = exact_quantiles(expected, [], names, linear_probs(bins)).select("feature", "quantiles").collect()
    edges = {r["feature"]: sorted(set(r["quantiles"])) for r in found}
    return {c: edges.get(c, []) for c in names}


def bin_counts(df: DataFrame, by: list[str], edges: dict[str, list[float]]) -> DataFrame:
    """``by, feature, n, counts``: present values and rows per bin as a map.

    Bins are [e0,e1), [e1,e2), ..., the last one closed. Key -1 counts values outside.
    """
    cuts = {c: [*e[:-1], math.nextafter(e[-1], math.inf)] if e else [0.0] for c, e in edges.items()}
    last = F.create_map(*(x for c, e in edges.items() for x in (F.lit(c), F.lit(len(e) - 1))))
    placed = cut_stacked(df, by, cuts)
    inside = (F.col("bucket") > 0) & (F.col("bucket") <= last[F.col("feature")])
    return (
        placed.groupBy(*by, "feature", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin", F.when(inside, F.col("bucket") - 1).otherwise(-1))
        .groupBy(*by, "feature", "bin")
        .agg(F.sum("n").alias("n"))
        .groupBy(*by, "feature")
        .agg(
            F.sum("n").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("counts"),
        )
    )


def _in_bins(counts: Column) -> Column:
    return F.aggregate(
        F.map_values(F.map_filter(counts, lambda k, v: k >= 0)), F.lit(0).cast("bigint"), lambda a, b: a + b
    )


def _share(counts: Column, i: Column, total: Column) -> Column:
    n = F.coalesce(F.try_element_at(counts, i), F.lit(0)).cast("double")
    return (n + COUNT_PAD) / (total + TOTAL_PAD)


def psi_of(n_edges: Column, expected: Column, actual: Column, n_e: Column, n_a: Column, undefined: float) -> Column:
    """Stability index of two count maps over the same bins, clamped to [0, PSI_CAP].

    Shares are of the rows inside the edges. Too few values or edges give ``undefined``.
    """
    def term(i: Column) -> Column:
        e = _share(expected, i, F.col("in_e"))
        a = _share(actual, i, F.col("in_a"))
        return (a - e) * F.ln(a / e)

    places = F.sequence(F.lit(0), F.greatest(n_edges - 2, F.lit(0)))
    total = F.aggregate(F.transform(places, term), F.lit(0.0), lambda a, b: a + b)
    enough = (n_e >= MIN_VALUES) & (n_a >= MIN_VALUES) & (n_edges >= MIN_EDGES)
    return F.when(
        F.coalesce(enough, F.lit(False)), F.greatest(F.lit(0.0), F.least(total, F.lit(PSI_CAP)))
    ).otherwise(F.lit(undefined))


def _with_psi(table: DataFrame, edges: dict[str, list[float]], undefined: float) -> DataFrame:
    """Add ``psi`` to a table with ``feature, e, a, n_e, n_a``."""
    n_edges = F.create_map(*(x for c, e in edges.items() for x in (F.lit(c), F.lit(len(e)))))
    sums = table.withColumns({
        "n_edges": n_edges[F.col("feature")],
        "in_e": _in_bins(F.col("e")).cast("double"), "in_a": _in_bins(F.col("a")).cast("double"),
    })
    value = psi_of(*(F.col(c) for c in ("n_edges", "e", "a", "n_e", "n_a")), undefined)
    return sums.withColumn("psi", value)


def psi(split: DataFrame, names: list[str], bins: int = BINS, undefined: float = INFINITE) -> DataFrame:
    """Index of each numeric feature, train against out-of-time rows.

    ``feature, psi, out_of_range_share``. Values beyond the training range are in no
    bin, so the index does not see them; the share does.
    """
    edges = quantile_edges(split.filter(F.col("split") == "train"), names, bins)
    counts = bin_counts(split, ["split"], edges)

    def side(tag: str, alias: str) -> list[Column]:
        mine = F.col("split") == tag
        return [
            F.max(F.when(mine, F.col("n"))).alias(f"n_{alias}"),
            F.first(F.when(mine, F.col("counts")), ignorenulls=True).alias(f"{alias}"),
        ]

    sides = counts.groupBy("feature").agg(*side("train", "e"), *side("oot", "a"))
    outside = ratio(
        F.coalesce(F.try_element_at("a", F.lit(-1)), F.lit(0)).cast("double"), F.col("n_a").cast("double")
    )
    listed = split.sparkSession.createDataFrame([(c,) for c in names], "feature string")
    return _with_psi(listed.join(F.broadcast(sides), "feature", "left"), edges, undefined).select(
        "feature", "psi", outside.alias("out_of_range_share")
    )


def numeric_stability(split: DataFrame, roles: Roles, names: list[str] | None = None, labels: DataFrame | None = None) -> DataFrame:
    """Stable numeric features: low index, or a middling one with target correlation.

    ``feature, stability, out_of_range_share, corr, keep``. ``labels`` are the rows
    whose labels may be used (default: all).
    """
    names = names if names is not None else roles.numeric(split)
    moments = numeric_moments(labels if labels is not None else split, names, roles.target).select(
        "feature", "constant", "corr"
    )
    value = F.col("psi")
    keep = (value < STABLE_PSI) | (
        (value < UNSTABLE_PSI) & (F.abs("corr") > MODERATE_MIN_CORR)
    )
    return psi(split, names).join(F.broadcast(moments), "feature").select(
        "feature", value.alias("stability"), "out_of_range_share", "corr",
        (F.coalesce(keep, F.lit(False)) & ~F.coalesce("constant", F.lit(True))).alias("keep"),
    )


def aligned_categories(table: DataFrame) -> DataFrame:
    """Train and out-of-time rows of every category seen in either: ``feature, value, train, oot``."""
    return table.select(
        "feature", "value", (F.col("t0") + F.col("t1")).alias("train"), (F.col("o0") + F.col("o1")).alias("oot")
    )


def categorical_stability(
    split: DataFrame, roles: Roles, names: list[str] | None = None, use_oot_labels: bool = True,
    max_categories: int | None = None,
) -> DataFrame:
    """Stable text features: shares alike in both splits, or informative about the target; none of more than
    ``max_categories`` categories, if given.

    ``feature, n_categories, chi2, dof, stability, mi, keep``. The test is for equal
    category shares in the two splits, whatever their sizes.
    """
    names = names if names is not None else roles.categorical(split)
    table = contingency(split, names, roles.target, by_split=True)
    both = aligned_categories(table)
    test = chi2_two_columns(both, F.col("train"), F.col("oot"), yates=False)
    used = ("n0", "n1") if use_oot_labels else ("t0", "t1")
    mi = mutual_information(table, *(F.col(c) for c in used))
    fits = F.col("n_categories") >= MIN_CATEGORIES
    if max_categories is not None:
        fits = fits & (F.col("n_categories") <= max_categories)
    keep = fits & (
        (F.col("p") > STABLE_P) | (F.col("p").isNotNull() & (F.col("mi") > MIN_MI))
    )
    return test.join(F.broadcast(mi), "feature").select(
        "feature", "n_categories", "chi2", "dof", F.col("p").alias("stability"), "mi",
        F.coalesce(keep, F.lit(False)).alias("keep"),
    )


def monthly_psi(
    train: DataFrame,
    population: DataFrame,
    roles: Roles,
    names: list[str] | None = None,
    months: int | None = None,
    bins: int = BINS,
    min_rows: int = MIN_MONTH_ROWS,
) -> DataFrame:
    """Index of each numeric feature, training rows against each month; none for months below ``min_rows``.

    ``month, feature, samples, psi, error``. All features and months unless limited.
    One job covers all months; the edges and the training counts are one row per feature.
    """
    names = names if names is not None else [c for c in roles.numeric(train) if c in population.columns]
    dated = population.filter(col(roles.date).isNotNull()).withColumn(
        "month", F.date_format(col(roles.date), "yyyy-MM")
    )
    edges = quantile_edges(train, names, bins)
    expected = bin_counts(train, [], edges).select(
        "feature", F.col("n").alias("n_e"), F.col("counts").alias("e")
    )
    actual = bin_counts(dated, ["month"], edges).select(
        "month", "feature", F.col("n").alias("n_a"), F.col("counts").alias("a")
    )
    sizes = dated.groupBy("month").agg(F.count(F.lit(1)).alias("samples"))
    if months is not None:
        sizes = sizes.orderBy("month").limit(months)
    listed = sizes.withColumn("feature", F.explode(F.array(*(F.lit(c) for c in names))))
    small = F.col("samples") < min_rows
    joined = listed.join(actual, ["month", "feature"], "left").join(F.broadcast(expected), "feature", "left")
    return _with_psi(joined, edges, 0.0).select(
        "month", "feature", "samples",
        F.when(~small, F.col("psi")).alias("psi"),
        F.when(small, F.format_string("Insufficient data (%d samples)", F.col("samples"))).alias("error"),
    )


def monthly_category_psi(
    train: DataFrame, population: DataFrame, roles: Roles, names: list[str] | None = None, min_rows: int = MIN_MONTH_ROWS
) -> DataFrame:
    """Index of text features on category shares, training rows against each month.

    ``month, feature, samples, psi, error``. A category absent on one side counts zero
    rows. Categories absent from a month are not spelled out: with z the share of
    an empty category, sum (z - e)(ln z - ln e) over them needs only four sums
    over all expected categories, less the same sums over those the month has.
    """
    names = names if names is not None else [c for c in roles.categorical(train) if c in population.columns]
    dated = population.filter(col(roles.date).isNotNull()).withColumn(
        "month", F.date_format(col(roles.date), "yyyy-MM")
    )

    def counted(df: DataFrame, by: list[str], alias: str) -> DataFrame:
        long = stacked(df, by, {c: [col(c)] for c in names}, ["value"]).filter(F.col("value").isNotNull())
        return long.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias(alias))

    def share(n: Column, total: Column) -> Column:
        return (F.coalesce(n, F.lit(0)) + COUNT_PAD) / (total + TOTAL_PAD)

    seen = F.col("n_e").isNotNull()
    e = share(F.col("n_e"), F.col("all_e"))
    sums = [
        F.count_if(seen), F.sum(F.when(seen, F.ln(e))),
        F.sum(F.when(seen, e)), F.sum(F.when(seen, e * F.ln(e))),
    ]
    expected = counted(train, [], "n_e")
    all_e = expected.groupBy("feature").agg(F.sum("n_e").cast("double").alias("all_e"))
    whole = expected.join(F.broadcast(all_e), "feature").groupBy("feature").agg(
        F.first("all_e").alias("all_e"), *(s.alias(f"s{i}") for i, s in enumerate(sums))
    )
    actual = counted(dated, ["month"], "n_a")
    all_a = actual.groupBy("month", "feature").agg(F.sum("n_a").cast("double").alias("all_a"))
    a = share(F.col("n_a"), F.col("all_a"))
    met = (
        actual.join(expected, ["feature", "value"], "left")
        .join(F.broadcast(all_a), ["month", "feature"])
        .join(F.broadcast(all_e), "feature")
        .groupBy("month", "feature")
        .agg(
            F.first("all_a").alias("all_a"),
            F.sum((a - e) * F.ln(a / e)).alias("met"),
            *(F.coalesce(s, F.lit(0.0)).alias(f"p{i}") for i, s in enumerate(sums)),
        )
    )
    z = COUNT_PAD / (F.col("all_a") + TOTAL_PAD)
    left = [F.col(f"s{i}") - F.col(f"p{i}") for i in range(4)]
    unmet = F.when(
        left[0] > 0, left[0] * z * F.ln(z) - z * left[1] - F.ln(z) * left[2] + left[3]
    ).otherwise(0.0)
    enough = (F.col("all_e") >= MIN_VALUES) & (F.col("all_a") >= MIN_VALUES)
    value = F.when(
        enough, F.greatest(F.lit(0.0), F.least(F.col("met") + unmet, F.lit(PSI_CAP)))
    ).otherwise(0.0)
    sizes = dated.groupBy("month").agg(F.count(F.lit(1)).alias("samples"))
    small = F.col("samples") < min_rows
    return met.join(F.broadcast(whole), "feature").join(F.broadcast(sizes), "month").select(
        "month", "feature", "samples",
        F.when(~small, value).alias("psi"),
        F.when(small, F.format_string("Insufficient data (%d samples)", F.col("samples"))).alias("error"),
    )
