"""Findings of round 3: fits that stop and run side by side, curves in one pass, joins by measured size, files in lots."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from tabsift import Roles
from tabsift.operators import search, training

ROLES = Roles(ids=("id",), target="label", date="day")


@pytest.fixture(scope="module")
def told(spark):
    """A column that tells the label, one that half tells it, and a text."""
    rows = spark.range(600).select("id", (F.col("id") * 7919 % 5 < 2).cast("int").alias("label"))
    return rows.select(
        "id", "label", (F.col("label") * 10.0 + F.col("id") % 7).alias("told"),
        (F.col("label") * 2.0 + F.col("id") * 31 % 5).alias("half"), (F.col("id") % 3).cast("string").alias("text")).persist()


def test_boosting_stops_where_patience_runs_out(told):
    leader = training.train_leader(told, ROLES, ["told"], "AUC", 1, 0, early_stop=True)
    values = [r["value"] for r in leader.curve.orderBy("round").collect()]
    assert values == [1.0] * 11 and leader.model.stages[-1].getNumTrees == 1
    # A patience that does not run out sees all rounds.
    leader = training.train_leader(told, ROLES, ["half"], "AUC", 1, 0, early_stop=True, patience=50, most_rounds=13)
    assert leader.curve.count() == 13


def test_models_side_by_side_are_those_of_a_cross_validator(told):
    features = ["half", "text"]
    boards = [training.train_leader(told, ROLES, features, "AUC", 2, 3, parallelism=n).leaderboard.collect() for n in (1, 5)]
    assert boards[0] == boards[1]
    rows = training.training_rows(told, ROLES, features, 3, 42).persist()
    for name, estimator in training.candidates(42, bins=training.tree_bins(rows, features))[:2]:
        found = CrossValidator(
            estimator=Pipeline(stages=[*training.feature_stages(rows, features), estimator]), numFolds=3, foldCol="fold", seed=42,
            estimatorParamMaps=ParamGridBuilder().build(), evaluator=training.evaluator("AUC")).fit(rows)
        assert {r["model"]: r["score"] for r in boards[0]}[name] == pytest.approx(found.avgMetrics[0], abs=1e-12)
    assert training.at_once(rows.coalesce(1)) >= training.at_once(rows.repartition(64)) == 1
    few = told.filter("id < 2")
    with pytest.raises(ValueError):
        training.train_leader(few, ROLES, ["half"], "AUC", 1, 5)


def test_settings_side_by_side_give_the_same_board(told):
    found = [search.search_leader(told, ROLES, ["half"], "AUC", 3, 2, parallelism=n).leaderboard.collect() for n in (1, None)]
    assert found[0] == found[1]


def test_curves_share_one_sorting(spark):
    from tabsift.operators import boosting, evaluation

    rows = spark.range(4000).select(
        (F.col("id") % 5 + 1).alias("round"), (F.col("id") * 7919 % 11 < 4).cast("int").alias("label"),
        (F.col("id") * 31 % 97 / 10.0 + F.col("id") % 2).alias("score"))
    rows = rows.unionByName(spark.createDataFrame([(6, 1, 0.5), (6, 1, None), (7, None, 0.1)], "round long, label int, score double"))
    found = {(r["metric"], r["round"]): r["value"] for r in boosting.metric_curves(rows, "label", ["AUC", "AUCPR", "F1"]).collect()}
    area = {r["round"]: r["auc"] for r in evaluation.auc(rows, "score", "label", ["round"]).collect()}
    precision = {r["round"]: r["average_precision"] for r in evaluation.average_precision_by(rows, "score", "label", ["round"]).collect()}
    assert set(area) == set(precision) == {k for m, k in found if m == "AUC"} == {1, 2, 3, 4, 5, 6}
    for k in area:
        assert found["AUC", k] == (area[k] if area[k] is None else pytest.approx(area[k], abs=1e-12))
        assert found["AUCPR", k] == pytest.approx(precision[k], abs=1e-12)


def _joins(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_medians_and_edges_are_sent_to_the_rows(spark, capsys):
    from tabsift.operators import cleaning, evaluation

    rows = spark.range(2_000_000).select(
        "id", F.when(F.col("id") % 3 > 0, F.col("id") % 1000).cast("double").alias("x"), (F.col("id") % 2).cast("string").alias("split"),
        (F.col("id") % 2).cast("int").alias("label"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("day"))
    filled = cleaning.impute_median(rows, ["x"])
    assert "SortMergeJoin" not in _joins(filled, capsys)
    assert filled.filter("x is null").isEmpty()
    assert "SortMergeJoin" not in _joins(evaluation.score_bins(rows, ROLES, "x"), capsys)


def test_rows_are_read_once_by_a_fit(spark):
    from tabsift.operators import selection

    passes = spark.sparkContext.accumulator(0)

    def row(i):
        passes.add(1)
        return (i, i * 7919 % 5 % 2, float(i % 17), str(i % 3), "train")

    rows = spark.createDataFrame(spark.sparkContext.parallelize(range(200), 2).map(row), "id long, label int, x double, text string, split string")
    for find in (selection.forest_importance, selection.boosted_importance):
        before = passes.value
        find(rows, ["x", "text"], "label").collect()
        assert passes.value - before == 200


def test_large_lots_of_requests_lie_in_several_files(spark, tmp_path):
    import glob
    import os

    from suite import queries as Q

    events = spark.range(9000).select(
        F.col("id").alias("event_id"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval((F.col("id") % 30).cast("int"))).alias("ts"))
    for file_rows, wanted in ((1000, 3), (5000, 1)):
        path = str(tmp_path / str(file_rows))
        assert Q._delivered(events, path, file_rows) == wanted
        files = sorted(glob.glob(f"{path}/in/*.parquet"), key=os.path.getmtime)
        assert len(files) == 3 * wanted
        for k in range(3):
            got = sorted(r[0] for r in spark.read.parquet(*files[wanted * k:wanted * (k + 1)]).select("event_id").collect())
            mine = [i for i in range(9000) if i % 30 // 10 == k and i % 97]
            late = [i for i in range(9000) if i % 30 // 10 == k - 1 and i % 97 == 0]
            assert got == sorted(mine + [i for i in mine if i % 2 == 0] + late)
