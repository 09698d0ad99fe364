"""Scoring rows as they arrive, and watching the scores."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabsift.functions.columns import closed_right_bin, col
from tabsift.operators.scoring import score_batch
from tabsift.session import scratch_path


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """New parquet files as a stream; ``path`` is a folder or a pattern."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def score_stream(stream: DataFrame, model: PipelineModel, features: list[str], keep: list[str]) -> DataFrame:
    """The same preparation and model as for tables; no state is kept."""
    return score_batch(stream, model, features, keep)


def monitor_stream(
    scored: DataFrame, ts: str, score: str, label: str, edges: list[float],
    window: str = "30 days", late: str = "1 day",
) -> DataFrame:
    """Rows, positives and score range per time window and score bin.

    The bins have fixed edges, since quantiles of a window are not known while it
    fills. Scores below the first edge are in bin -1, those above the last in the bin after the last, missing ones in
    bin NULL. State is one row per open window and bin.
    """
    stamped = scored.withColumn(ts, col(ts).cast("timestamp"))  # a watermark needs this type
    if scored.isStreaming:
        stamped = stamped.withWatermark(ts, late)
    bins = F.array(*(F.lit(float(e)) for e in edges))
    placed = stamped.withColumn("bin", closed_right_bin(col(score), bins, len(edges)))
    return (
        placed.groupBy(F.window(ts, window).alias("w"), "bin")
        .agg(
            F.count(F.lit(1)).alias("count_population"),
            F.sum(col(label)).cast("bigint").alias("count_positive"),
            F.min(score).alias("score_min"),
            F.max(score).alias("score_max"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bin",
            "count_population", "count_positive", "score_min", "score_max",
        )
    )


def run_available(stream: DataFrame, name: str, mode: str = "append", path: str | None = None) -> DataFrame:
    """Process what is there, write it below ``path`` and return it as a table.

    Output and progress lie together, so a run with the ``path`` of an earlier one goes on where that stopped;
    without a ``path`` both are new, in the shared folder, and ``name`` is part of theirs. ``append`` writes a group
    once its window is behind the watermark; ``complete`` keeps the last state of every group and is for few groups.
    """
    spark = stream.sparkSession
    base = path.rstrip("/") if path else scratch_path(spark, name)
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{base}/progress")
    if mode == "append":
        query = writer.format("parquet").option("path", f"{base}/rows").outputMode("append").start()
    else:
        # The state of all groups replaces the table with every batch.
        def replace(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/rows")

        query = writer.foreachBatch(replace).outputMode(mode).start()
    query.awaitTermination()
    return spark.read.parquet(f"{base}/rows")
