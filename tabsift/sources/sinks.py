"""Stage tables, report files and the run record."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tabsift.session import scratch_path


def write_stage(df: DataFrame, path: str, by: str | None = "split", sort: str | None = None) -> None:
    """Write a stage table, one folder per ``by`` value for partition pruning.

    Rows stay in the partitions they are in, so a split that holds most rows is
    still written by all tasks.
    """
    if sort:
        df = df.sortWithinPartitions(sort)
    writer = df.write.mode("overwrite")
    if by and by in df.columns:
        writer = writer.partitionBy(by)
    writer.parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def measured(df: DataFrame, name: str) -> DataFrame:
    """A table made from groups, written once: Spark then knows its size and sends a small one to the rows that are
    joined with it. Unwritten it counts as large, and all of those rows are shuffled by the group."""
    path = scratch_path(df.sparkSession, name)
    write_stage(df, path, by=None)
    return read_stage(df.sparkSession, path)


def feature_report(selected: DataFrame, split: DataFrame) -> DataFrame:
    """One row: selected features in rank order, row and column counts per split.

    ``selected`` has one row per feature (``rank``, ``feature``).
    """
    counts = split.agg(
        F.count_if(F.col("split") == "train").alias("train_rows"),
        F.count_if(F.col("split") == "oot").alias("oot_rows"),
    )
    names = selected.select(F.struct("rank", "feature").alias("name"))
    return names.unionByName(counts, allowMissingColumns=True).agg(
        F.transform(F.array_sort(F.collect_list("name")), lambda s: s["feature"]).alias("selected_features"),
        F.max("train_rows").alias("train_rows"),
        F.max("oot_rows").alias("oot_rows"),
        F.lit(len(split.columns) - 1).alias("n_columns"),
    )


def write_feature_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)


def final_feature_list(
    report: DataFrame, model_type: str, metric: str, train_score: float, oot_score: float
) -> DataFrame:
    """The report of the training step: features, model type, metric and scores."""
    return report.select(
        F.col("selected_features").alias("final_features"),
        F.lit(model_type).alias("model_type"),
        F.lit(metric).alias("optimization_metric"),
        F.lit(float(train_score)).alias("train_score"),
        F.lit(float(oot_score)).alias("oot_score"),
    )


def evaluation_json(sections: dict[str, DataFrame], evaluated_at: str) -> DataFrame:
    """One JSON document from small section tables (months x bins, months x features).

    Each section becomes an array of its rows; the time stamp is given by the
    caller so that equal input gives an equal document.
    """
    parts = None
    for name, table in sections.items():
        rows = table.agg(
            F.array_sort(F.collect_list(F.to_json(F.struct("*")))).alias("rows")
        ).select(F.lit(name).alias("section"), "rows")
        parts = rows if parts is None else parts.unionByName(rows)
    # Rows are JSON already, so the sections are joined as text.
    body = F.concat(
        F.lit('"'), F.col("section"), F.lit('":['), F.array_join("rows", ","), F.lit("]")
    )
    joined = F.array_join(F.array_sort(F.collect_list(body)), ",")
    stamp = F.lit(f'"evaluation_date":"{evaluated_at}"')
    return parts.agg(
        F.concat(F.lit("{"), joined, F.lit(","), stamp, F.lit("}")).alias("evaluation_summary")
    )


def write_evaluation(sections: dict[str, DataFrame], evaluated_at: str, path: str) -> None:
    evaluation_json(sections, evaluated_at).coalesce(1).write.mode("overwrite").text(path)


MANIFEST = "section string, n_rows long, path string, fields string, evaluated_at string"


def write_sections(sections: dict[str, DataFrame], evaluated_at: str, path: str) -> None:
    """The evaluation as folders of JSON lines, one per section, and a manifest written after all of them.

    A section of any size is written by as many tasks as it has parts. Readers go by the manifest, so they see the
    sections of a finished evaluation only; its rows name each section's fields, as JSON leaves out what is missing.
    """
    if not sections or not all(name.replace("_", "a").isalnum() for name in sections):
        raise ValueError("sections are named by letters, digits and underscores")
    spark = next(iter(sections.values())).sparkSession
    rows = []
    for name, table in sections.items():
        table.write.mode("overwrite").json(f"{path}/sections/{name}")
        fields = table.schema.json()
        written = spark.read.schema(table.schema).json(f"{path}/sections/{name}").count()
        rows.append((name, written, f"sections/{name}", fields, evaluated_at))
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def read_sections(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The sections that the manifest names; one whose rows are not as many as it says is an error."""
    found = {}
    for r in spark.read.schema(MANIFEST).json(f"{path}/manifest").collect():  # a row per section
        table = spark.read.schema(StructType.fromJson(json.loads(r["fields"]))).json(f"{path}/{r['path']}")
        if table.count() != r["n_rows"]:
            raise ValueError(f"section {r['section']} does not have the {r['n_rows']} rows of its manifest")
        found[r["section"]] = table
    return found


def run_rows(
    spark: SparkSession,
    run_id: str,
    params: dict[str, object],
    metrics: dict[str, float],
    tags: dict[str, str],
) -> DataFrame:
    """Run record in long form: ``run_id, kind, key, value``."""
    rows = [
        (run_id, kind, key, str(value))
        for kind, items in (("param", params), ("metric", metrics), ("tag", tags))
        for key, value in items.items()
    ]
    return spark.createDataFrame(rows, "run_id string, kind string, key string, value string")


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    params: dict[str, object],
    metrics: dict[str, float],
    tags: dict[str, str],
) -> None:
    """Append a run to the ``runs`` table; earlier runs are never rewritten."""
    run_rows(spark, run_id, params, metrics, tags).coalesce(1).write.mode("append").parquet(path)


