"""The steps in a row: read, preprocess, train, evaluate, record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabsift.operators.scoring import score_batch
from tabsift.operators.training import Leader, generalisation_gap, model_performance, save_model, train_leader
from tabsift.plans.evaluate import evaluate
from tabsift.plans.preprocess import Prepared, SelectionOptions, preprocess
from tabsift.roles import Roles, Windows
from tabsift.sources.sinks import (
    final_feature_list,
    log_run,
    read_stage,
    write_evaluation,
    write_sections,
    write_feature_report,
    write_stage,
)
from tabsift.sources.tables import read_table


@dataclass
class PipelineRun:
    prepared: Prepared
    leader: Leader
    performance: DataFrame
    sections: dict[str, DataFrame]


def run_pipeline(
    spark: SparkSession,
    table: str,
    out: str,
    roles: Roles,
    windows: Windows,
    run_id: str,
    evaluated_at: str,
    metric: str = "AUCPR",
    max_models: int = 2,
    folds: int = 5,
    seed: int = 42,
    options: SelectionOptions = SelectionOptions(),
) -> PipelineRun:
    """Read ``table`` and leave stages, model, reports and run record below ``out``."""
    prepared = preprocess(read_table(spark, table), roles, windows, f"{out}/stage", options)
    write_feature_report(prepared.report, f"{out}/feature_report")
    leader = train_leader(prepared.split, roles, prepared.features, metric, max_models, folds, seed)
    save_model(leader, f"{out}/leader")
    keep = [*roles.fixed, "split"]
    write_stage(score_batch(prepared.split, leader.model, leader.features, keep), f"{out}/scored")
    scored = read_stage(spark, f"{out}/scored")
    performance = model_performance(scored, roles.target)
    column = {"AUC": "auc", "AUCPR": "aucpr", "F1": "f1"}[metric.upper()]
    gap = generalisation_gap(performance, column).first()
    write_feature_report(
        final_feature_list(prepared.report, leader.name, metric, gap["train_score"], gap["oot_score"]),
        f"{out}/feature_list",
    )
    sections = evaluate(
        prepared.split.filter(F.col("split") == "train").drop("split"), prepared.split.drop("split"), roles,
        gap["train_score"], gap["oot_score"], metric, start=windows.train_start, end=windows.oot_end,
        scored=scored.drop("split"),
    )
    write_evaluation(sections, evaluated_at, f"{out}/evaluation")
    write_sections(sections, evaluated_at, f"{out}/evaluation_sections")
    shapes = prepared.report.first()
    name = metric.lower()
    log_run(
        spark, f"{out}/runs", run_id,
        params={
            "optimization_metric": metric, "max_models": max_models, "folds": folds, "seed": seed,
            "num_features": len(prepared.features),
            "features_from": prepared.source,
            "train_samples": shapes["train_rows"], "oot_samples": shapes["oot_rows"],
        },
        metrics={
            f"train_{name}": gap["train_score"], f"oot_{name}": gap["oot_score"], "train_oot_diff": gap["abs_gap"],
        },
        tags={"model_type": leader.name},
    )
    return PipelineRun(prepared, leader, performance, sections)
