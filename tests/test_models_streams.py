"""Models, whole runs and streams: invariants and planted features."""

import json

import pytest
from pyspark.sql import functions as F

from suite import queries as Q
from suite import views as V
from tabsift.functions.columns import closed_right_bin
from tabsift.operators import cleaning, selection, training
from tabsift.operators.scoring import score_batch
from tabsift.plans.pipeline import run_pipeline
from tabsift.plans.preprocess import SelectionOptions, prepare, preprocess, screened, select_features
from tabsift.sources import read_stage
from tabsift.streaming import monitor_stream, read_stream, run_available, score_stream


@pytest.fixture(scope="module")
def parts(spark, sf):
    return Q.staged(spark, sf)


@pytest.fixture(scope="module")
def leader(parts):
    return training.train_leader(parts.filled, V.RISK, ["total_price", "acctbal", "seg_signal"], "AUCPR", 2, 0)


def test_planted_features_get_the_right_verdicts(parts):
    ranked = {r["feature"]: r for r in select_features(parts, V.RISK).collect()}
    assert ranked["total_price"]["selected"] and ranked["seg_signal"]["selected"]
    assert ranked["drift_up"]["selected"]
    assert not {"drift_half", "const_col", "sparse_col"} & set(ranked)


def test_small_integers_are_kept(parts):
    assert "n_lines" in screened(parts, V.RISK)


@pytest.mark.parametrize(
    "options",
    [SelectionOptions(screen_on="filled"), SelectionOptions(stats_on="imputed"), SelectionOptions(use_oot_labels=False)],
)
def test_selection_options(parts, options):
    chosen = {r["feature"] for r in select_features(parts, V.RISK, options).filter("selected").collect()}
    assert {"total_price", "seg_signal"} <= chosen and "drift_half" not in chosen


def test_more_than_three_hundred_features(spark, sf):
    wide = V.risk_orders(spark, sf).select(
        "risk_id", "partition_date", "label", "total_price",
        *(((F.col("risk_id") * p) % 1009).cast("double").alias(f"f{i}") for i, p in enumerate(range(1013, 1013 + 620, 2))),
    )
    splits = prepare(wide, V.RISK, V.WINDOWS)
    names = screened(splits, V.RISK)
    assert len(names) == 311 and "total_price" in names
    few = screened(splits, V.RISK, SelectionOptions(significant=20))
    assert len(few) <= 20 and "total_price" in few


def test_forest_finds_the_planted_feature(parts):
    rows = selection.forest_importance(parts.filled, ["acctbal", "avg_disc", "total_price", "segment", "seg_signal"], "label").collect()
    assert sum(r["importance"] for r in rows) == pytest.approx(1.0)
    assert max(rows, key=lambda r: r["importance"])["feature"] in ("seg_signal", "total_price")


def test_blend_is_for_any_number_of_features(parts):
    spark = parts.filled.sparkSession
    few = spark.createDataFrame([("total_price", "numeric", 0.1, 0.5, 0.6)], "feature string, kind string, stability double, target_score double, score double")
    assert selection.forest_blend(few, parts.filled, "label").first()["score"] == pytest.approx(0.6 * 0.6 + 0.4)
    assert select_features(parts, V.RISK, SelectionOptions(forest=True)).filter("selected").count() > 0


def test_selection_does_not_change_with_the_number_of_features(spark):
    def ranked(n, **options):
        rows = [(f"f{i}", "numeric", 0.1 if i % 2 else 0.5, 1.0, 1.0 - i / 2000.0) for i in range(n)]
        table = spark.createDataFrame(rows, "feature string, kind string, stability double, target_score double, score double")
        return selection.rank_selected(table, **options).orderBy("rank").collect()

    for n in (10, 500, 501, 1001):
        got = ranked(n)
        chosen = [r["feature"] for r in got if r["selected"]]
        tiers = [r["tier"] for r in got if r["selected"]]
        assert tiers == sorted(tiers) and len(chosen) >= 0.9 * n
        assert [r["feature"] for r in ranked(n, most=7) if r["selected"]] == chosen[:7]


def test_an_empty_selection_has_a_defined_outcome(spark, sf, tmp_path):
    rows = V.risk_orders(spark, sf).select("risk_id", "partition_date", "label", "drift_half", "const_col")
    with pytest.raises(ValueError, match="no feature is left"):
        preprocess(rows, V.RISK, V.WINDOWS, str(tmp_path / "a"))
    found = preprocess(rows, V.RISK, V.WINDOWS, str(tmp_path / "b"), SelectionOptions(on_empty="fallback"))
    assert found.source == "fallback" and found.features == ["drift_half"]
    with pytest.raises(ValueError):
        SelectionOptions(on_empty="maybe")


def test_early_stopping_with_and_without_folds(parts):
    for folds in (0, 3):
        leader = training.train_leader(parts.filled, V.RISK, ["total_price", "acctbal"], "AUC", 1, folds, early_stop=True)
        assert leader.leaderboard.first()["score"] > 0.6
    with pytest.raises(ValueError, match="max_models"):
        training.train_leader(parts.filled, V.RISK, ["total_price"], "AUC", 4, 0)


def test_held_rows_are_apart_from_the_folds(parts):
    rows = training.training_rows(parts.filled, V.RISK, ["total_price"], 3, 42)
    shares = {r["fold"]: r["s"] for r in rows.groupBy("fold").agg(F.avg(F.col("validation__").cast("int")).alias("s")).collect()}
    assert set(shares) == {0, 1, 2} and all(0.03 < s < 0.2 for s in shares.values())


def test_trees_take_many_categories(spark):
    rows = spark.createDataFrame([(i, float(i % 2), f"c{i % 90}", "train") for i in range(900)], "id long, label double, text string, split string")
    assert training.tree_bins(rows, ["text"]) == 91
    assert selection.forest_importance(rows, ["text"], "label").count() == 1


def test_a_resumed_stream_repeats_nothing(spark, parts, leader, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = parts.filled.drop("split").withColumn("acctbal", F.when(F.col("risk_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("acctbal")))
    for half in (0, 1):
        rows.filter(F.col("risk_id") % 2 == half).write.mode("append").parquet(source)
        stream = read_stream(spark, source, rows.schema)
        got = run_available(score_stream(stream, leader.model, leader.features, ["risk_id"]), "scores", path=out)
    assert sorted(got.collect()) == sorted(score_batch(rows, leader.model, leader.features, ["risk_id"]).collect())
    assert got.count() == rows.count()


def test_codes_of_a_hot_value_join_on_a_salt(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 10 else f"v{i}", "a") for i in range(2000)], "id long, x string, y string")
    assert sorted(cleaning.factorize(rows, ["x", "y"], small=1).collect()) == sorted(cleaning.factorize(rows, ["x", "y"]).collect())
    assert "Exchange hashpartitioning" not in cleaning.factorize(rows, ["x", "y"])._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]


def test_bins_have_places_for_missing_and_far_values(spark):
    rows = spark.createDataFrame([(x,) for x in (None, float("nan"), -5.0, 0.0, 0.5, 1.0, 2.0, 99.0)], "x double")
    edges = F.array(F.lit(0.0), F.lit(1.0), F.lit(2.0))
    got = [r[0] for r in rows.select(closed_right_bin(F.col("x"), edges, 3)).collect()]
    assert got == [None, None, -1, 0, 0, 0, 1, 2]


def test_boosted_fallback(parts):
    got = selection.boosted_importance(parts.filled, ["acctbal", "total_price"], "label").collect()
    assert got[0]["feature"] == "total_price"


def test_leader(leader):
    board = leader.leaderboard.collect()
    assert [r["place"] for r in board] == [1, 2] and board[0]["model"] == leader.name
    assert board[0]["score"] >= board[1]["score"]


def test_same_seed_same_leader(parts, leader):
    again = training.train_leader(parts.filled, V.RISK, leader.features, "AUCPR", 2, 0)
    assert again.name == leader.name and again.leaderboard.collect() == leader.leaderboard.collect()


def test_unknown_metric(parts):
    with pytest.raises(ValueError):
        training.train_leader(parts.filled, V.RISK, ["total_price"], "RMSE")


def test_scores_are_probabilities_and_survive_saving(spark, parts, leader, tmp_path):
    training.save_model(leader, str(tmp_path))
    model, features = training.load_model(spark, str(tmp_path))
    a = score_batch(parts.filled, leader.model, leader.features, ["risk_id"])
    b = score_batch(parts.filled, model, features, ["risk_id"])
    assert features == leader.features
    assert sorted(a.collect()) == sorted(b.collect())
    low, high = a.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= low < high <= 1.0


def test_request_with_missing_and_extra_columns(parts, leader):
    request = parts.filled.drop("acctbal").withColumn("extra", F.lit(1))
    assert score_batch(request, leader.model, leader.features, ["risk_id"]).filter("score is null").count() == 0


def test_stream_scores_equal_batch_scores(spark, sf, parts, leader, tmp_path):
    path = str(tmp_path / "in")
    parts.filled.drop("split").repartition(4).write.parquet(path)
    schema = spark.read.parquet(path).schema
    stream = read_stream(spark, path, schema, max_files=1)
    got = run_available(score_stream(stream, leader.model, leader.features, ["risk_id"]), "scores")
    want = score_batch(parts.filled, leader.model, leader.features, ["risk_id"])
    assert sorted(got.collect()) == sorted(want.collect())


def test_monitor_equals_batch(spark, sf, tmp_path):
    rows = V.stream_events(spark, sf).select("ts", F.col("value").alias("s"), (F.col("user_id") % 2).cast("int").alias("y"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), rows.schema, max_files=1)
    edges = [0.0, 20.0, 60.0, 500.0]
    got = run_available(monitor_stream(stream, "ts", "s", "y", edges), "monitor", "complete")
    want = monitor_stream(rows, "ts", "s", "y", edges)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_whole_run(spark, sf, tmp_path):
    table = str(tmp_path / "risk.parquet")
    V.risk_orders(spark, sf).write.parquet(table)
    out = str(tmp_path / "out")
    run = run_pipeline(spark, table, out, V.RISK, V.WINDOWS, "run-1", "2024-10-01T00:00:00", "AUC", max_models=1, folds=0)
    report = json.loads(spark.read.text(f"{out}/feature_report").first()[0])
    assert report["selected_features"] == run.prepared.features
    document = json.loads(spark.read.text(f"{out}/evaluation").first()[0])
    assert set(document) == {"performance", "monthly_auc", "early_vs_latest_analysis", "bin_analysis", "psi_analysis", "evaluation_date"}
    assert {r["period"] for r in document["early_vs_latest_analysis"]} == {"early", "latest"}
    keys = {r["key"] for r in read_stage(spark, f"{out}/runs").collect()}
    assert {"train_auc", "oot_auc", "train_oot_diff", "num_features", "model_type"} <= keys
    assert run.performance.filter("split = 'train'").first()["auc"] > 0.9
