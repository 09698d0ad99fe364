"""Streams with memory: quantile bins per window from a sketch, and requests that are scored once."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window, functions as F

from tabsift.functions.columns import col
from tabsift.operators.scoring import score_batch
from tabsift.operators.sketches import KLL_SIZE, rank_error, rows_between, sketch_grid, sketched_edges


def sketch_stream(
    scored: DataFrame, ts: str, score: str, label: str, window: str = "30 days", late: str = "1 day", size: int = KLL_SIZE,
) -> DataFrame:
    """Per time window its rows, missing scores, and a quantile sketch of all scores and of the positive ones.

    ``window_start, window_end, count_population, missing, count_positive, sketch, positives``. The state of a window is
    two sketches of bounded size, however many rows it has.
    """
    stamped = scored.withColumn(ts, col(ts).cast("timestamp"))  # a watermark needs this type
    if scored.isStreaming:
        stamped = stamped.withWatermark(ts, late)
    value = col(score).cast("double")
    present = F.when(~F.isnan(value), value + F.lit(0.0))
    hit = F.when(col(label) == 1, F.col("__score"))
    return stamped.withColumn("__score", present).groupBy(F.window(ts, window).alias("w")).agg(
        F.count("__score").alias("count_population"), F.count_if(F.col("__score").isNull()).alias("missing"),
        F.count(hit).alias("count_positive"), F.kll_sketch_agg_double("__score", size).alias("sketch"),
        F.kll_sketch_agg_double(hit, size).alias("positives"),
    ).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "count_population", "missing",
        "count_positive", "sketch", "positives")


def quantile_bins(sketches: DataFrame, bins: int = 10, size: int = KLL_SIZE) -> DataFrame:
    """The windows of ``sketch_stream`` cut at their own quantiles, one row per window and bin.

    ``window_start, window_end, bin, low, high, count_population, count_positive, error_rows``. Edges and counts are
    read from the sketches; error_rows is by how many rows a count may be off (two ranks, each within ``rank_error``).
    Bins are closed on the right, the first on both sides; a window with fewer than two distinct edges has none.
    """
    # A sketch of no values can't be read.
    hits = F.when(F.col("count_positive") > 0, sketch_grid(F.col("positives")))
    edged = sketches.filter(F.col("count_population") > 0).withColumns(
        {"edges": sketched_edges(F.col("sketch"), bins), "grid": sketch_grid(F.col("sketch")), "hits": hits})
    placed = edged.withColumn("bin", F.explode(F.sequence(F.lit(0), F.greatest(F.size("edges") - 2, F.lit(0))))).filter(F.size("edges") > 1)
    low, high, first = F.get("edges", F.col("bin")), F.get("edges", F.col("bin") + 1), F.col("bin") == 0
    positive = rows_between(F.col("hits"), F.col("count_positive"), F.col("low"), F.col("high"), first)
    return placed.withColumns({"low": low, "high": high}).select(
        "window_start", "window_end", "bin", "low", "high",
        F.round(rows_between(F.col("grid"), F.col("count_population"), F.col("low"), F.col("high"), first)).cast("long").alias("count_population"),
        F.coalesce(F.round(positive), F.lit(0)).cast("long").alias("count_positive"),
        F.ceil(2 * rank_error(size) * F.col("count_population")).cast("long").alias("error_rows"))


def score_requests(
    stream: DataFrame, model: PipelineModel, features: list[str], keep: list[str], ids: list[str], ts: str, path: str,
    late: str = "1 day",
) -> tuple[DataFrame, DataFrame]:
    """Score a stream in which requests repeat and come late; ``(scores, late rows)`` below ``path``.

    The watermark of a batch is the newest time of earlier batches less ``late``. Rows behind it are not scored but kept
    with ``watermark``, the time they missed. Of the others each id is scored once: its earliest row of the batch, if the id
    was not seen with a time of at most ``late`` before the watermark. Only such times are read back, which the files'
    ranges of times leave out by the file. A batch that is run again gives the same rows in the same place, and a
    resumed run goes on with the same watermark; NULL times are never late.
    """
    spark = stream.sparkSession
    stamped = stream.withColumn(ts, col(ts).cast("timestamp"))
    kinds = ", ".join(f"`{c}` {stamped.schema[c].dataType.simpleString()}" for c in [*ids, ts])
    span = F.expr(f"interval {late}")
    first = Window.partitionBy(*(col(c) for c in ids)).orderBy(col(ts).asc_nulls_last(), F.xxhash64(*(col(c) for c in stamped.columns)))

    def step(batch: DataFrame, number: int) -> None:
        rows = batch.persist()
        try:
            seen = _written(spark, f"{path}/seen", kinds).filter(F.col("batch") < number)
            newest = _written(spark, f"{path}/newest", "newest timestamp").filter(F.col("batch") < number)
            top = newest.agg(F.max("newest")).first()[0]  # a row per batch
            mark = F.lit(top).cast("timestamp") - span
            behind = F.lit(False) if top is None else F.coalesce(col(ts) < mark, F.lit(False))
            rows.filter(behind).withColumn("watermark", mark).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
            fresh = rows.filter(~behind).withColumn("__first", F.row_number().over(first)).filter("__first = 1").drop("__first")
            if top is not None:
                held = seen.filter(col(ts).isNull() | (col(ts) >= mark - span)).select(*(col(c) for c in ids)).distinct()
                fresh = fresh.join(held, ids, "left_anti")
            fresh = fresh.select(*(col(c) for c in stamped.columns)).persist()
            score_batch(fresh, model, features, keep).write.mode("overwrite").parquet(f"{path}/scores/batch={number}")
            fresh.select(*(col(c) for c in [*ids, ts])).write.mode("overwrite").parquet(f"{path}/seen/batch={number}")
            rows.agg(F.max(col(ts)).alias("newest")).write.mode("overwrite").parquet(f"{path}/newest/batch={number}")
            fresh.unpersist()
        finally:
            rows.unpersist()

    query = stamped.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{path}/progress").foreachBatch(step).start()
    query.awaitTermination()
    return tuple(spark.read.option("basePath", f"{path}/{part}").parquet(f"{path}/{part}").drop("batch") for part in ("scores", "late"))


def _written(spark, path: str, schema: str) -> DataFrame:
    """What earlier batches wrote, with ``batch``; nothing before the first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], f"{schema}, batch long")
    return spark.read.schema(f"{schema}, batch long").option("basePath", path).parquet(path)
