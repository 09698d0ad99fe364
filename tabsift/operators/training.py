"""Training and comparing models with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tabsift.functions.columns import col
from tabsift.operators.boosting import STOP_ROUNDS, STOP_TOLERANCE, patient_rounds
from tabsift.operators.encoding import hashed_place
from tabsift.operators.evaluation import auc, average_precision_by, f1_score
from tabsift.roles import Roles

# Metric names accepted.
METRICS = {"AUC": "areaUnderROC", "AUCPR": "areaUnderPR", "F1": "fMeasureByLabel"}
# Rounds of boosted trees, and the most that early stopping looks at.
ROUNDS, MOST_ROUNDS = 20, 40
# Share of the rows that tell early stopping when to stop; the model is fitted on all rows afterwards.
VALIDATION_SHARE = 0.1
# Bins of a numeric feature in tree models; text features may need more.
NUMERIC_BINS = 64
# Most models fitted side by side where one has fewer tasks than there are cores, and where its tasks are short: each keeps the
# driver busy with its steps. By core, the most rows that these learn from together, and the most tasks of one step of each.
MOST_AT_ONCE, SHORT_AT_ONCE = 6, 2
ROWS_A_CORE, TASKS_A_CORE = 700_000, 12


def feature_stages(df: DataFrame, features: list[str], out: str = "features") -> list:
    """Index text features in sorted order and assemble one vector column.

    The model holds the category list of each text feature; ``max_categories`` of the stability screen bounds it.
    """
    text = [f for f in features if isinstance(df.schema[f].dataType, T.StringType)]
    stages = []
    if text:
        stages.append(
            StringIndexer(
                inputCols=text, outputCols=[f"{c}__code" for c in text],
                stringOrderType="alphabetAsc", handleInvalid="keep",
            )
        )
    inputs = [f"{f}__code" if f in text else f for f in features]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep")]


def tree_bins(df: DataFrame, features: list[str]) -> int:
    """Bins that tree models need: as many as the categories of any text feature, one more for unseen ones."""
    text = [f for f in features if isinstance(df.schema[f].dataType, T.StringType)]
    if not text:
        return NUMERIC_BINS
    most = df.agg(*(F.count_distinct(col(c)) for c in text)).first()
    return max(NUMERIC_BINS, max(most) + 1)


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """``y, samples, class_weight``: the smaller class weighs as much as the larger."""
    counts = (
        df.filter(col(target).isNotNull())
        .groupBy(col(target).cast("int").alias("y"))
        .agg(F.count(F.lit(1)).alias("samples"))
    )
    most = F.max("samples").over(Window.partitionBy(F.lit(1)))  # one row per class
    return counts.withColumn("class_weight", most / F.col("samples"))


def balance_classes(df: DataFrame, target: str) -> DataFrame:
    """Add the class weight as a column; two rows are read to the driver first."""
    weights = {r["y"]: r["class_weight"] for r in class_weights(df, target).collect()}
    weight = F.lit(1.0)
    for y, w in weights.items():
        weight = F.when(col(target) == y, w).otherwise(weight)
    return df.withColumn("class_weight", weight)


def fold_of(roles: Roles, folds: int, seed: int = 42):
    """Fold number from a hash of the ids: the same on every run and cluster."""
    return F.pmod(F.xxhash64(F.lit(seed), *(col(c) for c in roles.ids)), F.lit(folds)).cast("int")


def held_for_stopping(roles: Roles, share: float = VALIDATION_SHARE, seed: int = 42):
    """Whether a row tells early stopping when to stop, by a hash that has nothing to do with the folds."""
    place = F.pmod(F.xxhash64(F.lit(seed), F.lit("validation"), *(col(c) for c in roles.ids)), F.lit(1_000_000))
    return place < int(share * 1_000_000)


def candidates(seed: int = 42, rounds: int = ROUNDS, bins: int = NUMERIC_BINS) -> list[tuple[str, Estimator]]:
    """Models to try, in order."""
    common = {"featuresCol": "features", "labelCol": "label__", "weightCol": "class_weight"}
    boosted = GBTClassifier(maxIter=rounds, maxDepth=5, seed=seed, maxBins=bins, **common)
    return [
        ("gradient_boosted_trees", boosted),
        (
            "random_forest",
            RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed, maxBins=bins, **common),
        ),
        ("logistic_regression", LogisticRegression(maxIter=50, regParam=0.01, **common)),
    ]


@dataclass
class Leader:
    """Best model, its name, the feature order, the leaderboard rows, and the curve that early stopping read."""

    name: str
    model: PipelineModel
    features: list[str]
    leaderboard: DataFrame
    curve: DataFrame | None = None


def training_rows(
    split: DataFrame, roles: Roles, features: list[str], folds: int, seed: int, place: bool = False
) -> DataFrame:
    """Training rows with only the columns a model reads; ``place`` adds a place in [0, 1) apart from the folds."""
    return balance_classes(_model_columns(split, roles, features, folds, seed, place), "label__")


def _model_columns(split: DataFrame, roles: Roles, features: list[str], folds: int, seed: int, place: bool) -> DataFrame:
    rows = split.filter(F.col("split") == "train") if "split" in split.columns else split
    return rows.filter(col(roles.target).isNotNull()).select(
        *(col(f) for f in features),
        col(roles.target).cast("double").alias("label__"),
        fold_of(roles, max(folds, 1), seed).alias("fold"),
        held_for_stopping(roles, seed=seed).alias("validation__"),
        *([hashed_place(list(roles.ids), seed).alias("place__")] if place else []),
    )


@contextmanager
def kept_training_rows(
    split: DataFrame, roles: Roles, features: list[str], folds: int, seed: int, place: bool = False
) -> Iterator[DataFrame]:
    """``training_rows``, kept while models are fitted; they are kept before the class weights are counted, so that
    their source is read once."""
    rows = _model_columns(split, roles, features, folds, seed, place).persist()
    try:
        yield balance_classes(rows, "label__")
    finally:
        rows.unpersist()


def at_once(rows: DataFrame, share: float = 1.0) -> int:
    """How many models to fit side by side on a ``share`` of the rows: as many as leave no core idle. A fit of few rows has few or
    short tasks at a time and waits for each of its many steps to be sent out; of many rows each step fills the cluster, and a
    second fit would only take memory."""
    parts = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    tasks, n = parts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    cores, tasks = rows.sparkSession.sparkContext.defaultParallelism, max(1, tasks)
    short = min(SHORT_AT_ONCE, cores * TASKS_A_CORE // tasks, int(cores * ROWS_A_CORE / max(1.0, n * share)))
    return max(1, min(MOST_AT_ONCE, cores // tasks), short)


def side_by_side(spark, work: Sequence[Callable[[], object]], parallelism: int) -> list:
    """The results of some calls in their order, ``parallelism`` of them at a time."""
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(w)) for w in work]]


def check_folds(rows: DataFrame, folds: int) -> None:
    """Every fold must have rows, and rows outside it."""
    found = {r["fold"] for r in rows.select("fold").distinct().collect()}
    for k in range(folds):
        if not found - {k}:
            raise ValueError(f"the training data at fold {k} is empty")
        if k not in found:
            raise ValueError(f"the validation data at fold {k} is empty")


def evaluator(metric: str):
    name = METRICS[metric.upper()]
    if metric.upper() == "F1":
        return MulticlassClassificationEvaluator(labelCol="label__", metricName=name, metricLabel=1.0)
    # No bins: the curve has a point for every distinct score.
    return BinaryClassificationEvaluator(labelCol="label__", metricName=name, numBins=0)


def train_leader(
    split: DataFrame,
    roles: Roles,
    features: list[str],
    metric: str = "AUCPR",
    max_models: int = 2,
    folds: int = 5,
    seed: int = 42,
    early_stop: bool = False,
    patience: int = STOP_ROUNDS,
    tolerance: float = STOP_TOLERANCE,
    most_rounds: int = MOST_ROUNDS,
    parallelism: int | None = None,
) -> Leader:
    """Fit up to ``max_models`` models and keep the best by cross-validated metric.

    ``folds=0`` ranks by the metric on the training rows instead. With ``early_stop`` boosted trees are judged by the
    metric after every round, up to ``most_rounds``, on a share of the rows (``VALIDATION_SHARE``, chosen apart from the
    folds); after ``patience`` rounds without a gain of ``tolerance`` the best round so far is their number of rounds, and
    models of that number are fitted as all others. The curve is part of the leader. Models and folds are fitted
    ``parallelism`` at a time (default: ``at_once``); one at a time, only the best by folds is fitted on all rows.
    """
    if metric.upper() not in METRICS:
        raise ValueError(f"unknown metric {metric!r}: use one of {sorted(METRICS)}")
    if not 1 <= max_models <= len(candidates()):
        raise ValueError(f"max_models must be 1 to {len(candidates())}, not {max_models}")
    if not features:
        raise ValueError("no features to train on")
    judge, spark = evaluator(metric), split.sparkSession
    board, best, rounds, curve = [], None, ROUNDS, None
    with kept_training_rows(split, roles, features, folds, seed) as rows:
        bins, stages = tree_bins(rows, features), feature_stages(rows, features)
        if folds > 1:
            check_folds(rows, folds)
        if early_stop:
            boosted = dict(candidates(seed, most_rounds, bins))["gradient_boosted_trees"]
            rounds, curve = patient_rounds(stages, boosted, rows, "validation__", "label__", metric, patience, tolerance)

        def judged(pipeline: Pipeline, fold: int) -> float:
            model = pipeline.fit(rows.filter(F.col("fold") != fold))
            return float(judge.evaluate(model.transform(rows.filter(F.col("fold") == fold))))

        def whole(pipeline: Pipeline) -> tuple[PipelineModel, float | None]:
            model = pipeline.fit(rows)
            return model, None if folds > 1 else float(judge.evaluate(model.transform(rows)))

        tried = [(name, Pipeline(stages=[*stages, e])) for name, e in candidates(seed, rounds, bins)[:max_models]]
        judgings = folds if folds > 1 else 0
        most = parallelism or (at_once(rows) if len(tried) * (1 + judgings) > 1 else 1)
        # Where no core idles, only the leader is fitted on all rows: the folds have said which it is, nothing reads the others.
        late = judgings > 0 and most == 1
        work = [w for _, p in tried for w in (
            *([] if late else [lambda p=p: whole(p)]), *((lambda p=p, k=k: judged(p, k)) for k in range(judgings)))]
        done = iter(side_by_side(spark, work, most))
        for name, pipeline in tried:
            model, score = (None, None) if late else next(done)
            if folds > 1:
                score = sum(next(done) for _ in range(folds)) / folds
            board.append((name, metric.upper(), score))
            if best is None or score > best[1]:
                best = (name, score, model, pipeline)
        leader = whole(best[3])[0] if late else best[2]
    board.sort(key=lambda r: (-r[2], r[0]))
    table = spark.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(board)], "place int, model string, metric string, score double"
    )
    return Leader(best[0], leader, list(features), table, curve)


def model_performance(scored: DataFrame, label: str, score: str = "score") -> DataFrame:
    """Exact AUC, average precision and F1 per split: ``split, samples, auc, aucpr, f1``."""
    roc = auc(scored, score, label, by=["split"])
    pr = average_precision_by(scored, score, label, by=["split"])
    decided = f1_score(scored, score, label, by=["split"])
    return (
        roc.join(F.broadcast(pr.select("split", "average_precision")), "split")
        .join(F.broadcast(decided), "split")
        .select("split", "samples", "auc", F.col("average_precision").alias("aucpr"), "f1")
    )


def generalisation_gap(performance: DataFrame, metric: str = "auc") -> DataFrame:
    """One row: train and out-of-time score, their difference and its size."""
    def at(tag: str):
        return F.max(F.when(F.col("split") == tag, F.col(metric)))

    return performance.agg(at("train").alias("train_score"), at("oot").alias("oot_score")).select(
        "train_score", "oot_score",
        (F.col("train_score") - F.col("oot_score")).alias("gap"),
        F.abs(F.col("train_score") - F.col("oot_score")).alias("abs_gap"),
    )


def save_model(leader: Leader, path: str) -> None:
    """The pipeline, and beside it the feature list in model order."""
    leader.model.write().overwrite().save(f"{path}/model")
    rows = [(i, f) for i, f in enumerate(leader.features)]
    leader.leaderboard.sparkSession.createDataFrame(rows, "position int, feature string").coalesce(
        1
    ).write.mode("overwrite").parquet(f"{path}/features")


def load_model(spark, path: str) -> tuple[PipelineModel, list[str]]:
    rows = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    return PipelineModel.load(f"{path}/model"), [r["feature"] for r in rows]
