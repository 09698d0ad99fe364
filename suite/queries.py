"""The registered queries: each reads whole tables and returns a DataFrame."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from suite import views as V
from tabsift.functions.columns import linear_probs
from tabsift.operators import boosting, checks, cleaning, drift, encoding, evaluation, profile, ranking, search, selection
from tabsift.operators import significance, sketches, splitting, training
from tabsift.operators.scoring import score_batch
from tabsift.plans import drift_store
from tabsift.plans.evaluate import evaluate
from tabsift.plans.preprocess import (
    Splits,
    feature_scores,
    fallback_features,
    prepare,
    select_features,
    stage,
)
from tabsift.session import scratch_path
from tabsift.sources import log_run, read_columns, read_stage, read_table, table_info, write_stage
from tabsift.sources.sinks import evaluation_json, feature_report, measured, read_sections, write_sections
from tabsift.streaming import (
    monitor_stream,
    quantile_bins,
    read_stream,
    run_available,
    score_requests,
    score_stream,
    sketch_stream,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Features of the example table after constants are dropped.
NUMERIC = [
    "total_price", "acctbal", "n_lines", "sum_qty", "avg_disc",
    "drift_half", "drift_some", "drift_up", "sparse_col",
]
TEXT = ["seg_signal", "priority", "segment"]
# Events of a lot in one file of requests.
LOT_FILE_ROWS = 1_000_000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round floats for comparison; adding zero drops the sign of zero."""
    return df.select(
        *(
            (F.round(F.col(f.name), places) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def splits(spark: SparkSession, sf: str) -> Splits:
    return prepare(V.risk_orders(spark, sf), V.RISK, V.WINDOWS)


def staged(spark: SparkSession, sf: str) -> Splits:
    """The splits from a written table, for queries that pass over them many times."""
    return stage(splits(spark, sf), V.RISK, scratch_path(spark, "splits"))


# Sources and sinks


@query
def table_scan(spark, sf):
    return read_table(spark, f"{sf}/customer.parquet")


@query
def first_columns(spark, sf):
    return read_columns(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])


@query
def table_shape(spark, sf):
    return table_info(V.table(spark, sf, "orders"))


@query
def stage_roundtrip(spark, sf):
    path = scratch_path(spark, "stage")
    write_stage(splitting.split_by_date(V.risk_orders(spark, sf), V.RISK.date, V.WINDOWS), path)
    return rounded(
        read_stage(spark, path).groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_lines").alias("lines"), F.sum("label").alias("positives")
        )
    )


@query
def narrow_types(spark, sf):
    return rounded(cleaning.narrow_plan(V.table(spark, sf, "lineitem")))


@query
def narrow_cast(spark, sf):
    cast = cleaning.narrow_types(V.table(spark, sf, "lineitem"))
    return table_info(cast).select("column_name", "dtype", "n_rows")


@query
def selection_report(spark, sf):
    parts = staged(spark, sf)
    chosen = profile.settle(select_features(parts, V.RISK)).filter("selected")
    names = [r["feature"] for r in chosen.orderBy("rank").collect()]
    report = feature_report(chosen, cleaning.keep_features(parts.filled, V.RISK, names))
    return report.withColumn("selected_features", F.array_join("selected_features", ","))


@query
def run_record(spark, sf):
    area = evaluation.auc(V.scored_lines(spark, sf), "score", "label").first()
    path = scratch_path(spark, "runs")
    log_run(spark, path, "r1", {"train_samples": area["samples"]}, {"train_auc": area["auc"]}, {"model_type": "score"})
    log_run(spark, path, "r2", {}, {"positive_rate": area["positive_rate"]}, {})
    number = F.round(F.try_to_number("value", F.lit("9999999999.99999999999999999999")).cast("double"), 6)
    return spark.read.parquet(path).select("run_id", "kind", "key", number.alias("number"))


@query
def evaluation_document(spark, sf):
    return evaluation_json(_sections(spark, sf), "2024-10-01T00:00:00")


# Checks and profiling


@query
def duplicate_rows(spark, sf):
    lines = V.table(spark, sf, "lineitem")
    keyed = checks.duplicate_count(lines, ["l_orderkey", "l_linenumber"])
    target = checks.duplicate_count(lines, ["l_orderkey", "l_linenumber", "l_returnflag"])
    return keyed.select(F.lit("ids").alias("key"), "duplicates").unionByName(
        target.select(F.lit("ids and target").alias("key"), "duplicates")
    )


@query
def all_checks(spark, sf):
    return checks.data_checks(V.risk_orders(spark, sf), V.RISK, V.WINDOWS)


@query
def null_profile(spark, sf):
    return checks.null_profile(V.risk_orders(spark, sf))


@query
def value_counts(spark, sf):
    return checks.value_counts(V.table(spark, sf, "lineitem"), "l_partkey")


@query
def head_per_month(spark, sf):
    lines = V.scored_months(spark, sf)
    order = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_discount", "partition_date"]
    return checks.head_per_group(lines, "month", 20, order).select("month", *order[:5])


@query
def monthly_statistics(spark, sf):
    return rounded(checks.monthly_statistics(V.risk_orders(spark, sf), V.RISK))


# Projection and cleaning


@query
def select_roles(spark, sf):
    roles = V.Roles(V.RISK.ids, V.RISK.target, V.RISK.date, ("const_col", "sparse_col", "label"))
    return cleaning.select_roles(V.risk_orders(spark, sf), roles).drop("partition_date")


@query
def drop_constant(spark, sf):
    return cleaning.drop_constant(V.risk_orders(spark, sf), V.RISK).drop("partition_date")


@query
def fill_sentinel(spark, sf):
    return cleaning.fill_sentinel(V.risk_orders(spark, sf), V.RISK).drop("partition_date")


@query
def round_features(spark, sf):
    return cleaning.round_features(V.risk_orders(spark, sf), V.RISK).drop("partition_date")


@query
def parse_dates(spark, sf):
    text = V.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("d")
    )
    parsed = cleaning.to_datetime(text, "d")
    return parsed.select("o_orderkey", F.year("d").alias("year"), F.dayofyear("d").alias("day"))


@query
def keep_features(spark, sf):
    return cleaning.keep_features(V.risk_orders(spark, sf), V.RISK, ["total_price", "segment"]).drop("partition_date")


@query
def features_labels(spark, sf):
    rows = splits(spark, sf).filled
    (assembler,) = training.feature_stages(rows, ["total_price", "n_lines", "acctbal"])
    vector = vector_to_array(F.col("features"))
    return assembler.transform(rows).select(
        "risk_id", "label", vector[0].alias("f0"), vector[1].alias("f1"), vector[2].alias("f2")
    )


@query
def align_features(spark, sf):
    request = V.risk_orders(spark, sf).drop("acctbal")
    return cleaning.align_features(request, ["n_lines", "acctbal", "sum_qty", "sparse_col", "segment"], ["risk_id"])


@query
def impute_median(spark, sf):
    rows = staged(spark, sf).raw
    return rounded(cleaning.impute_median(rows, NUMERIC).select("risk_id", "split", *NUMERIC))


@query
def factorize(spark, sf):
    return cleaning.factorize(V.risk_orders(spark, sf).select("risk_id", *TEXT), TEXT)


# Filters, split, sample


@query
def time_split(spark, sf):
    return splitting.split_by_date(V.risk_orders(spark, sf), V.RISK.date, V.WINDOWS).select("risk_id", "split", "total_price")


@query
def between_dates(spark, sf):
    orders = V.table(spark, sf, "orders")
    return splitting.between_dates(orders, "o_orderdate", "1996-03-01", "1998-11-30").select("o_orderkey", "o_totalprice")


@query
def by_month(spark, sf):
    rows = splitting.by_month(V.scored_lines(spark, sf), V.LINES)
    return rounded(rows.groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most")
    ))


@query
def group_sizes(spark, sf):
    days = V.scored_lines(spark, sf).withColumn("day", F.date_format("partition_date", "yyyy-MM-dd"))
    return splitting.group_sizes(days, "day", "label")


@query
def hash_sample(spark, sf):
    orders = V.table(spark, sf, "orders")
    return splitting.sample_rows(orders, 500, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


# Combining


@query
def union_splits(spark, sf):
    rows = V.risk_orders(spark, sf)
    train = splitting.between_dates(rows, V.RISK.date, V.WINDOWS.train_start, V.WINDOWS.train_end)
    oot = splitting.between_dates(rows, V.RISK.date, V.WINDOWS.oot_start, V.WINDOWS.oot_end)
    both = splitting.union_splits(train, oot)
    return both.select("risk_id", "split", "label", "n_lines")


@query
def align_categories(spark, sf):
    rows = splits(spark, sf).filled
    return drift.aligned_categories(profile.contingency(rows, TEXT, "label", by_split=True))


@query
def reconcile_scores(spark, sf):
    a, b = V.two_scores(spark, sf)
    return rounded(evaluation.reconcile_scores(a, b, ["id"], tolerance=0.005))


# Feature quality


@query
def feature_moments(spark, sf):
    rows = splits(spark, sf).raw
    stats = profile.numeric_moments(rows, NUMERIC, "label")
    return rounded(stats.select(
        "feature", "n_rows", "n_valid", "missing_ratio", "mean", F.sqrt("variance").alias("deviation"),
        "min_value", "max_value",
    ), 4)


@query
def target_correlation(spark, sf):
    return rounded(profile.numeric_moments(splits(spark, sf).raw, NUMERIC, "label").select("feature", "corr"))


@query
def coef_variation(spark, sf):
    return rounded(profile.numeric_moments(splits(spark, sf).raw, NUMERIC, "label").select("feature", "cv"))


@query
def cardinality(spark, sf):
    return profile.cardinality(profile.contingency(splits(spark, sf).raw, TEXT, "label"))


@query
def chi2_quick(spark, sf):
    table = profile.contingency(splits(spark, sf).raw, TEXT, "label").filter(F.col("value").isNotNull())
    stats = profile.chi2_two_columns(table, F.col("n0"), F.col("n1"))
    return rounded(stats.select("feature", "n_categories", "p", (F.col("p") < profile.QUICK_P).alias("associated")))


@query
def quality_verdict(spark, sf):
    return rounded(profile.quality_verdict(
        splitting.split_by_date(V.risk_orders(spark, sf), V.RISK.date, V.WINDOWS).drop("const_col").withColumn(
            "constant_in_window", F.lit(7.0)
        ), V.RISK,
    ))


# Significance


@query
def pearson_score(spark, sf):
    rows = cleaning.impute_median(staged(spark, sf).raw.withColumn("all", F.lit("all")), NUMERIC, by="all")
    stats = profile.numeric_moments(rows, NUMERIC, "label")
    return rounded(stats.select("feature", (F.abs("corr") * significance.PEARSON_WEIGHT).alias("score")))


@query
def spearman(spark, sf):
    return rounded(significance.spearman(staged(spark, sf).filled, NUMERIC, "label"))


@query
def anova_f(spark, sf):
    stats = profile.anova(profile.numeric_moments(splits(spark, sf).filled, NUMERIC, "label"))
    return rounded(stats.select("feature", "f_stat", (F.col("f_p") < 0.05).alias("significant")), 4)


@query
def chi2_stat(spark, sf):
    table = profile.contingency(splits(spark, sf).filled, TEXT, "label")
    return rounded(profile.chi2_two_columns(table, F.col("n0"), F.col("n1")))


@query
def chi2_documents(spark, sf):
    table = profile.contingency(V.labelled_documents(spark, sf), ["lang", "source"], "label")
    return rounded(profile.chi2_two_columns(table, F.col("n0"), F.col("n1")).drop("p"))


@query
def mutual_info(spark, sf):
    table = profile.contingency(splits(spark, sf).filled, TEXT, "label")
    return rounded(profile.mutual_information(table, F.col("n0"), F.col("n1")))


@query
def significance_filter(spark, sf):
    rows = staged(spark, sf).filled
    return rounded(significance.significance_filter(significance.significance_score(rows, V.RISK), top=8), 4)


# Stability


@query
def psi_train_oot(spark, sf):
    return rounded(drift.psi(staged(spark, sf).filled, NUMERIC))


@query
def numeric_stability(spark, sf):
    # Infinite where an index has no meaning; compared as it is.
    return rounded(drift.numeric_stability(staged(spark, sf).filled, V.RISK))


@query
def categorical_stability(spark, sf):
    return rounded(drift.categorical_stability(splits(spark, sf).filled, V.RISK))


# Ranking and selection


@query
def numeric_relationship(spark, sf):
    return rounded(selection.numeric_relationship(staged(spark, sf).filled, NUMERIC, "label"))


@query
def categorical_relationship(spark, sf):
    return rounded(selection.categorical_relationship(splits(spark, sf).filled, TEXT, "label"))


@query
def combined_score(spark, sf):
    return rounded(feature_scores(staged(spark, sf), V.RISK))


@query
def score_threshold(spark, sf):
    scores = selection.score_threshold(feature_scores(staged(spark, sf), V.RISK))
    return rounded(scores.select("feature", "score_mean", "min_score"))


@query
def stability_tiers(spark, sf):
    tiers = selection.stability_tier(feature_scores(staged(spark, sf), V.RISK))
    return tiers.select("feature", "kind", "tier")


@query
def selected_features(spark, sf):
    return rounded(select_features(staged(spark, sf), V.RISK))


@query
def top_features(spark, sf):
    return rounded(selection.top_features(select_features(staged(spark, sf), V.RISK)))


@query
def quick_filter(spark, sf):
    found = selection.quick_filter(splits(spark, sf).raw, V.RISK)
    return rounded(found.select("feature", "missing_ratio", F.sqrt("variance").alias("deviation")), 4)


@query
def forest_importance(spark, sf):
    return selection.forest_importance(splits(spark, sf).filled, [*NUMERIC, *TEXT], "label")


@query
def forest_facts(spark, sf):
    """What holds for any forest: importances of all features sum to 1, a planted feature is first."""
    return _facts(forest_importance(spark, sf))


@query
def boosted_facts(spark, sf):
    return _facts(boosted_importance(spark, sf).filter("importance > 0")).drop("n_features")


def _facts(found):
    planted = F.max_by("feature", "importance").isin("total_price", "seg_signal", "drift_up", "drift_some", "drift_half")
    return found.agg(
        F.count(F.lit(1)).alias("n_features"), (F.round(F.sum("importance"), 6) == 1.0).alias("sum_is_one"),
        planted.alias("planted_first"))


@query
def forest_blend(spark, sf):
    parts = staged(spark, sf)
    scores = profile.settle(feature_scores(parts, V.RISK))
    names = [r["feature"] for r in scores.orderBy("feature").collect()]
    return selection.join_importance(scores, selection.forest_importance(parts.filled, names, "label"))


@query
def blend_given(spark, sf):
    """The blend of the statistical score with importances of a table; a feature that is not in it has none."""
    parts = staged(spark, sf)
    given = spark.createDataFrame([("total_price", 0.5), ("seg_signal", 0.25), ("acctbal", 0.25), ("unknown", 1.0)], "feature string, importance double")
    blended = selection.join_importance(profile.settle(feature_scores(parts, V.RISK)), given)
    return rounded(blended.select("feature", "kind", "stability", "target_score", "score"))


@query
def planted_importance(spark, sf):
    """A column that tells the label is the most important of any model; columns that never vary have no importance."""
    rows = splits(spark, sf).filled.withColumn("told", F.col("label") * 10.0 + F.col("risk_id") % 7).withColumn("flat", F.lit(3.0))
    names, out = ["told", "flat", "acctbal", "avg_disc", "priority"], None
    for name, found in (("forest", selection.forest_importance(rows, names, "label")), ("boosted", selection.boosted_importance(rows, names, "label"))):
        best = found.agg(F.max("importance").alias("best"))
        marked = splits(spark, sf).filled.sparkSession.createDataFrame([(c,) for c in names], "feature string").join(found, "feature", "left").join(F.broadcast(best))
        facts = marked.select(
            F.lit(name).alias("model"), "feature", (F.coalesce(F.col("importance") == F.col("best"), F.lit(False))).alias("is_first"),
            (F.col("feature") != "flat") | (F.coalesce("importance", F.lit(0.0)) == 0.0).alias("flat_has_none"))
        facts = facts.toDF("model", "feature", "is_first", "flat_has_none")
        out = facts if out is None else out.unionByName(facts)
    return out


@query
def boosted_importance(spark, sf):
    parts = staged(spark, sf)
    names = fallback_features(parts.filled, V.RISK)
    return selection.boosted_importance(parts.filled, names, "label")


# Training


@query
def class_weights(spark, sf):
    return rounded(training.class_weights(V.scored_lines(spark, sf), "label"))


def _leader(spark, sf, models=2, folds=3, early_stop=False):
    rows = staged(spark, sf).filled
    return rows, training.train_leader(rows, V.RISK, [*NUMERIC, *TEXT], "AUCPR", models, folds, early_stop=early_stop)


@query
def leaderboard(spark, sf):
    return _leader(spark, sf, models=3)[1].leaderboard


@query
def early_stop(spark, sf):
    return _leader(spark, sf, models=1, folds=0, early_stop=True)[1].leaderboard


@query
def leader_facts(spark, sf):
    """What holds for any leaderboard: every model once, places by falling score, better than chance; early stopping
    works with folds and without."""
    out = None
    for folds in (0, 3):
        board = _leader(spark, sf, models=3 if not folds else 1, folds=folds, early_stop=True)[1].leaderboard
        order = Window.orderBy("place")
        marked = board.withColumn("falls", F.coalesce(F.lag("score").over(order) >= F.col("score"), F.lit(True)))
        facts = marked.agg(
            F.lit(folds).alias("folds"), F.count_distinct("model").alias("models"), F.every("falls").alias("in_order"),
            (F.min("score") > 0.5).alias("better_than_chance"))
        out = facts if out is None else out.unionByName(facts)
    return out


@query
def average_precision(spark, sf):
    return rounded(evaluation.average_precision_by(V.scored_lines(spark, sf), "score", "label"))


@query
def model_performance(spark, sf):
    rows = splitting.split_by_date(V.scored_lines(spark, sf), "partition_date", V.LINE_WINDOWS)
    return rounded(training.model_performance(rows, "label"))


@query
def generalisation_gap(spark, sf):
    rows = splitting.split_by_date(V.scored_lines(spark, sf), "partition_date", V.LINE_WINDOWS)
    return rounded(training.generalisation_gap(evaluation.auc(rows, "score", "label", ["split"])))


def _logistic(rows, features):
    """A logistic model of number features, for scores that plain arithmetic can repeat."""
    named = [("logistic_regression", m) for n, m in training.candidates() if n == "logistic_regression"]
    ready = training.training_rows(rows, V.RISK, features, 0, 42)
    model = Pipeline(stages=[*training.feature_stages(ready, features), named[0][1]]).fit(ready)
    return training.Leader("logistic_regression", model, features, rows.sparkSession.createDataFrame([(1, "x")], "place int, model string"))


def _agrees(scored, inputs, leader, keys):
    """Whether each score is what the coefficients give on the prepared features."""
    fitted = leader.model.stages[-1]
    margin = F.lit(float(fitted.intercept))
    for name, weight in zip(leader.features, fitted.coefficients):
        value = F.when(F.isnan(F.col(name).cast("double")) | F.col(name).isNull(), F.lit(-999999.0)).otherwise(F.col(name).cast("double"))
        margin = margin + value * F.lit(float(weight))
    wanted = inputs.select(*keys, (1.0 / (1.0 + F.exp(-margin))).alias("wanted"))
    near = F.abs(F.col("score") - F.col("wanted")) < 1e-9
    return scored.join(wanted, keys).withColumn("agrees", F.coalesce(near, F.lit(False))).drop("score", "wanted")


def _with_gaps(rows, key, name):
    """Some values NULL, some NaN: both are missing."""
    return rows.withColumn(name, F.when(F.col(key) % 7 == 0, F.lit(None)).when(F.col(key) % 11 == 0, F.lit(float("nan"))).otherwise(F.col(name)))


PLAIN = ["total_price", "acctbal", "sum_qty", "avg_disc"]


@query
def batch_scores_agree(spark, sf):
    parts = splits(spark, sf)
    leader = _logistic(parts.filled, PLAIN)
    rows = _with_gaps(parts.raw, "risk_id", "acctbal")
    return _agrees(score_batch(rows, leader.model, PLAIN, ["risk_id", "split"]), rows, leader, ["risk_id", "split"])


@query
def saved_scores_agree(spark, sf):
    rows = splits(spark, sf).filled
    leader = _logistic(rows, PLAIN)
    path = scratch_path(spark, "model")
    training.save_model(leader, path)
    model, features = training.load_model(spark, path)
    return _agrees(score_batch(rows, model, features, ["risk_id"]), rows, leader, ["risk_id"])


@query
def stream_scores_agree(spark, sf):
    """A stream with NULL and NaN values, stopped after its first files and resumed."""
    parts = splits(spark, sf)
    leader = _logistic(parts.filled, PLAIN)
    rows = _with_gaps(parts.raw.select("risk_id", *PLAIN), "risk_id", "acctbal")
    path = scratch_path(spark, "stream")
    rows.filter("risk_id % 2 = 0").write.mode("append").parquet(f"{path}/in")
    for even in (True, False):
        if not even:
            rows.filter("risk_id % 2 <> 0").write.mode("append").parquet(f"{path}/in")
        stream = read_stream(spark, f"{path}/in", rows.schema)
        seen = run_available(score_stream(stream, leader.model, PLAIN, ["risk_id"]), "scores", path=f"{path}/out")
    return _agrees(seen, rows, leader, ["risk_id"])


@query
def saved_model_scores(spark, sf):
    rows, leader = _leader(spark, sf, models=1, folds=0)
    path = scratch_path(spark, "model")
    training.save_model(leader, path)
    model, features = training.load_model(spark, path)
    return score_batch(rows, model, features, ["risk_id", "label"])


# Evaluation


@query
def auc(spark, sf):
    return rounded(evaluation.auc(V.scored_lines(spark, sf), "score", "label"))


@query
def auc_continuous(spark, sf):
    return rounded(evaluation.auc(V.scored_lines(spark, sf), "l_extendedprice", "label"))


@query
def auc_documents(spark, sf):
    return rounded(evaluation.auc(V.labelled_documents(spark, sf), "n_chars", "label", ["lang"]))


@query
def f1(spark, sf):
    return rounded(evaluation.f1_score(V.scored_lines(spark, sf), "score", "label"))


@query
def monthly_auc(spark, sf):
    return rounded(evaluation.monthly_auc(V.scored_lines(spark, sf), V.LINES, "score", "1995-06-01", "2000-12-31"))


@query
def early_vs_latest(spark, sf):
    halves = evaluation.early_vs_latest(V.scored_lines(spark, sf), V.LINES, "score")
    return rounded(halves.withColumn("months", F.array_join("months", ",")))


@query
def score_bins(spark, sf):
    return rounded(evaluation.score_bins(V.gappy_lines(spark, sf), V.LINES, "score"), 9)


@query
def feature_bins(spark, sf):
    return rounded(evaluation.feature_bins(V.risk_orders(spark, sf), V.RISK).drop("score_min", "score_max", "score_mean"))


@query
def quantiles_by_month(spark, sf):
    found = ranking.exact_quantiles(V.scored_months(spark, sf), ["month"], ["l_extendedprice"], linear_probs(4))
    q = F.col("quantiles")
    return rounded(found.select("month", "n", *(q[i].alias(f"q{i}") for i in range(5))), 4)


@query
def monthly_psi(spark, sf):
    parts = staged(spark, sf)
    train = parts.filled.filter(F.col("split") == "train").drop("split")
    return rounded(drift.monthly_psi(train, parts.filled, V.RISK, NUMERIC))


@query
def monthly_category_psi(spark, sf):
    parts = splits(spark, sf)
    train = parts.filled.filter(F.col("split") == "train").drop("split")
    return rounded(drift.monthly_category_psi(train, parts.filled, V.RISK))


@query
def grades(spark, sf):
    rows = V.scored_months(spark, sf).withColumn(
        "split", F.when(F.month("partition_date") <= 6, "train").otherwise("oot")
    ).withColumn("year", F.year("partition_date"))
    by_year = evaluation.auc(rows, "score", "label", ["year", "split"])
    wide = by_year.groupBy("year").agg(
        F.max(F.when(F.col("split") == "train", F.col("auc"))).alias("train_score"),
        F.max(F.when(F.col("split") == "oot", F.col("auc"))).alias("oot_score"),
    ).filter("train_score is not null and oot_score is not null")
    return rounded(evaluation.grade_performance(wide, "AUC"))


def _sections(spark, sf):
    rows, leader = _leader(spark, sf, models=1, folds=0)
    train = rows.filter(F.col("split") == "train").drop("split")
    return evaluate(
        train, rows.drop("split"), V.RISK, 0.9, 0.85, "AUC", leader.model, leader.features,
        V.WINDOWS.train_start, V.WINDOWS.oot_end,
    )


@query
def evaluation_sections(spark, sf):
    out = None
    for name, section in _sections(spark, sf).items():
        counted = section.agg(F.lit(name).alias("section"), F.count(F.lit(1)).alias("n_rows"))
        out = counted if out is None else out.unionByName(counted)
    return out


@query
def evaluation_without_model(spark, sf):
    rows = staged(spark, sf).filled
    train = rows.filter(F.col("split") == "train").drop("split")
    sections = evaluate(train, rows.drop("split"), V.RISK, 0.9, 0.85, "AUC")
    return evaluation_json(sections, "2024-10-01T00:00:00")


# Scoring


@query
def batch_scores(spark, sf):
    rows, leader = _leader(spark, sf, models=1, folds=0)
    return score_batch(rows, leader.model, leader.features, ["risk_id", "label", "split"])


def _event_model(spark, sf):
    """A model of purchases from value and user, trained on all events."""
    events = V.stream_events(spark, sf).withColumn("label", F.when(F.col("event_type") == "purchase", 1).otherwise(0))
    roles = V.Roles(("event_id",), "label", "ts", ("event_type",))
    return training.train_leader(events, roles, ["value", "user_id"], "AUC", max_models=1, folds=0)


@query
def stream_scores(spark, sf):
    leader = _event_model(spark, sf)
    stream = read_stream(spark, f"{sf}/events.parquet*", V.table(spark, sf, "events").schema)
    return run_available(score_stream(stream, leader.model, leader.features, ["event_id"]), "stream_scores")


@query
def stream_monitor(spark, sf):
    stream = read_stream(spark, f"{sf}/events.parquet*", V.table(spark, sf, "events").schema).select(
        "ts", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("score"), F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label")
    )
    seen = run_available(
        monitor_stream(stream, "ts", "score", "label", [5.0, 10.0, 25.0, 50.0, 100.0], "1 day"),
        "stream_monitor", "complete",
    )
    spelled = [F.date_format(c, "yyyy-MM-dd HH:mm").alias(c) for c in ("window_start", "window_end")]
    return rounded(seen.select(*spelled, "bin", "count_population", "count_positive", "score_min", "score_max"))


# Rounds of boosting, settings, and category means


def _place():
    """A place in [0, 1) that has nothing to do with the label and that SQL can repeat."""
    return (F.col("risk_id") * 48271 % 2147483647).cast("double") / 2147483647.0


def _planted_rounds(spark, sf):
    """A score per order and round that gets better for eight rounds and stays as it is."""
    price = F.col("total_price") / 500000.0
    noise = (F.col("risk_id") * 7919 % 1009).cast("double") / 1009.0
    # The orders are written once, before each becomes thirty rows.
    orders = measured(V.risk_orders(spark, sf).select("label", price.alias("price"), noise.alias("noise")), "rounds")
    rounds = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("round"))
    return rounds.select("label", "round", (F.col("noise") + F.col("price") * (F.least("round", F.lit(8)).cast("double") * 0.25)).alias("score"))


@query
def patience_curve(spark, sf):
    scores = _planted_rounds(spark, sf)
    return rounded(boosting.metric_curves(scores, "label", ["AUC", "AUCPR"]))


@query
def patience_round(spark, sf):
    """Where patience runs out on those curves, for two settings of it."""
    metrics, out = ("AUC", "AUCPR"), None
    curves = profile.settle(boosting.metric_curves(_planted_rounds(spark, sf), "label", metrics))
    for metric in metrics:
        curve = curves.filter(F.col("metric") == metric)
        for patience, tolerance in ((10, 0.005), (2, 0.02)):
            found = boosting.patient_round(curve, patience, tolerance).select(F.lit(metric).alias("metric"), F.lit(patience).alias("patience"), "*")
            out = found if out is None else out.unionByName(found)
    return rounded(out)


@query
def round_scores_agree(spark, sf):
    """The scores after the last round of a boosted model are the model's own."""
    rows = splits(spark, sf).filled
    ready = training.training_rows(rows, V.RISK, NUMERIC, 0, 42).withColumn("risk_row", F.monotonically_increasing_id())
    boosted = dict(training.candidates(rounds=4))["gradient_boosted_trees"]
    fitted = Pipeline(stages=[*training.feature_stages(ready, NUMERIC), boosted]).fit(ready)
    scored = fitted.transform(ready).withColumn("own", vector_to_array("probability")[1])
    rounds = boosting.round_scores(fitted.stages[-1], scored.select("features", "own"), ["own"])
    return rounds.groupBy("round").agg(
        F.count(F.lit(1)).alias("n_rows"), F.every((F.abs(F.col("own") - F.col("score")) < 1e-12) | (F.col("round") < 4)).alias("agrees"))


@query
def halving_board(spark, sf):
    """Successive halving in which a column is its own model."""
    rows = splits(spark, sf).raw.filter(F.col("split") == "train")
    board = search.halving(NUMERIC, search.ranked_by_auc(rows, NUMERIC, "label", _place()))
    return rounded(spark.createDataFrame(board, search.BOARD))


@query
def search_board(spark, sf):
    return search.search_leader(splits(spark, sf).filled, V.RISK, [*NUMERIC, "seg_signal"], "AUC", settings=6, rungs=2).leaderboard


def _coded(rows):
    """With a text feature of many values."""
    return rows.withColumn("code", F.concat(F.lit("c"), (F.col("risk_id") % 211).cast("string")))


@query
def ordered_means(spark, sf):
    rows = _coded(splits(spark, sf).raw).filter(F.col("split") == "train")
    names = ["seg_signal", "priority", "code"]
    found = encoding.ordered_target_means(rows, names, "label", _place())
    return rounded(found.select("risk_id", *(f"{c}__mean" for c in names)))


@query
def applied_means(spark, sf):
    rows, names = _coded(splits(spark, sf).raw), ["seg_signal", "priority", "code"]
    train = rows.filter(F.col("split") == "train")
    found = encoding.apply_target_means(
        rows.filter(F.col("split") == "oot"), names, encoding.target_means(train, names, "label"), encoding.overall_mean(train, "label"))
    return rounded(found.select("risk_id", *(f"{c}__mean" for c in names)))


@query
def half_sample(spark, sf):
    orders = V.table(spark, sf, "orders")
    return splitting.sample_rows(orders, orders.count() // 2, ["o_orderkey"]).select("o_orderkey")


# Sections of an evaluation, written and read back


def _planted_sections(spark, sf):
    rows = staged(spark, sf).filled
    scored = rows.select(*V.RISK.fixed, (F.col("total_price") / 500000.0).alias("score"))
    sections = evaluate(
        rows.filter(F.col("split") == "train").drop("split"), rows.drop("split"), V.RISK, 0.9, 0.85, "AUC", scored=scored)
    path = scratch_path(spark, "evaluation")
    write_sections(sections, "2024-10-01T00:00:00", path)
    return path, read_sections(spark, path)


@query
def evaluation_manifest(spark, sf):
    path, _ = _planted_sections(spark, sf)
    return spark.read.json(f"{path}/manifest").select("section", "n_rows", "path", "evaluated_at")


@query
def section_performance(spark, sf):
    return rounded(_planted_sections(spark, sf)[1]["performance"])


@query
def section_monthly_auc(spark, sf):
    return rounded(_planted_sections(spark, sf)[1]["monthly_auc"])


@query
def section_early_vs_latest(spark, sf):
    return rounded(_planted_sections(spark, sf)[1]["early_vs_latest_analysis"].withColumn("months", F.array_join("months", ",")))


@query
def section_bins(spark, sf):
    return rounded(_planted_sections(spark, sf)[1]["bin_analysis"], 12)


@query
def section_psi(spark, sf):
    return rounded(_planted_sections(spark, sf)[1]["psi_analysis"])


# Summaries that merge


@query
def drift_store_psi(spark, sf):
    """Rows added in three batches, one of them twice."""
    parts = staged(spark, sf)
    path = scratch_path(spark, "drift")
    drift_store.start(parts.filled.filter(F.col("split") == "train").drop("split"), V.RISK, path, NUMERIC)
    for batch in (0, 1, 2, 1):
        drift_store.add(parts.filled.filter(F.col("risk_id") % 3 == batch), V.RISK, path, f"part-{batch}")
    return rounded(drift_store.current(spark, path))


@query
def distinct_sketches(spark, sf):
    """Whether the distinct values of united monthly sketches are within four deviations of the exact ones."""
    rows = V.risk_orders(spark, sf).withColumn("month", F.date_format("partition_date", "yyyy-MM"))
    names = ["total_price", "n_lines", "priority", "segment", "seg_signal"]
    whole = sketches.distinct_counts(sketches.merged_distinct(sketches.distinct_sketches(rows, ["month"], names), []))
    exact = rows.agg(*(F.count_distinct(F.col(c).cast("string")).alias(c) for c in names)).first()
    wanted = F.create_map(*(x for c in names for x in (F.lit(c), F.lit(exact[c]))))[F.col("feature")]
    near = F.abs(F.col("n_unique") - wanted) <= F.greatest(F.lit(1.0), 4 * sketches.distinct_error() * wanted)
    return whole.select("feature", "n_rows", "n_valid", near.alias("within_error"))


@query
def stream_quantile_bins(spark, sf):
    """Bins of a stream's windows from their sketches: whether counts are within the stated error of exact ones."""
    scores = V.table(spark, sf, "events").select("ts", F.col("value").alias("score"), (F.col("event_type") == "purchase").cast("int").alias("label"))
    stream = read_stream(spark, f"{sf}/events.parquet*", V.table(spark, sf, "events").schema).select(
        "ts", F.col("value").alias("score"), F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"))
    held = run_available(sketch_stream(stream, "ts", "score", "label", "7 days"), "stream_sketches", "complete")
    bins = quantile_bins(held, 4)
    inside = F.col("score").isNotNull() & (F.col("score") <= F.col("high")) & ((F.col("score") > F.col("low")) | ((F.col("bin") == 0) & (F.col("score") == F.col("low"))))
    exact = bins.join(scores.withColumn("ts", F.col("ts").cast("timestamp")), (F.col("ts") >= F.col("window_start")) & (F.col("ts") < F.col("window_end")) & inside)
    counted = exact.groupBy("window_start", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p"))
    near = (F.abs(F.col("count_population") - F.col("n")) <= F.col("error_rows") + 1) & (F.abs(F.col("count_positive") - F.col("p")) <= F.col("error_rows") + 1)
    both = bins.join(counted, ["window_start", "bin"], "left").withColumn("near", F.coalesce(near, F.lit(False)))
    found = both.groupBy("window_start").agg(F.max("bin").alias("last_bin"), F.every("near").alias("within_error"))
    sizes = held.select("window_start", (F.col("count_population") + F.col("missing")).alias("n_rows"), "count_positive")
    return sizes.join(found, "window_start").withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


def _delivered(events, path, file_rows):
    """Files of requests below ``path``/in, lot after lot; returns the files of a lot, the same for all.

    Lot k holds the events of some days, half of them again, and every 97th event of ten days before. A batch of the
    stream is a lot; a large one is written by several tasks.
    """
    day = F.to_date("ts")
    sizes = {r["d"]: r["n"] for r in events.groupBy(day.alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("d").asc_nulls_first()).collect()}
    days = list(sizes)
    lots = [days[i:i + 10] for i in range(0, len(days), 10)]
    rows_of = [sum(sizes[d] for d in lot) for lot in lots]
    files = max(1, min(math.ceil(max(rows_of) / file_rows), min(rows_of) // 1000))  # none of a small lot is empty
    number = F.floor((F.array_position(F.array(*(F.lit(d) for d in days)), day) - 1) / 10).cast("int")
    write_stage(events.withColumn("lot", number), f"{path}/lots", by="lot")
    dealt = read_stage(events.sparkSession, f"{path}/lots")
    for k in range(len(lots)):
        rows = dealt.filter((F.col("lot") == k) & (F.col("event_id") % 97 != 0))
        late = dealt.filter((F.col("lot") == k - 1) & (F.col("event_id") % 97 == 0))
        found = rows.unionByName(rows.filter("event_id % 2 = 0")).unionByName(late).select(*events.columns)
        (found.coalesce(1) if files == 1 else found.repartition(files)).write.mode("append").parquet(f"{path}/in")
    return files


@query
def stream_requests(spark, sf):
    """Events delivered twice, in files by day, a few of them late: scored once each, late ones set apart."""
    leader = _event_model(spark, sf)
    events = V.stream_events(spark, sf)
    path = scratch_path(spark, "requests")
    files = _delivered(events, path, LOT_FILE_ROWS)
    stream = read_stream(spark, f"{path}/in", events.schema, max_files=files)
    scores, late = score_requests(stream, leader.model, leader.features, ["event_id"], ["event_id"], "ts", f"{path}/out", "12 hours")
    kind = lambda df, name: df.select("event_id", F.lit(name).alias("kind"))
    return kind(scores, "scored").unionByName(kind(late, "late"))
