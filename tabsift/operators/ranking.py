"""Order statistics over whole columns without a whole column in one task.

Every value column is cut into buckets at its approximate quantiles, read from one
mergeable sketch per column. The cuts only balance the work; no result depends on
where they fall.
From there:

* quantiles need the bucket counts (a small aggregate) and then only the rows
  of the buckets that hold a wanted rank;
* rank sums (area under the curve, Spearman) are taken inside each bucket and
  shifted by the rows in the buckets before it;
* equal values are merged before they are shuffled, so a value that fills a
  third of the table is one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabsift.functions.columns import col, ratio
from tabsift.sources.sinks import measured

# Cut points over all value columns together: bounds what the driver holds and
# the number of (column, bucket) rows that are broadcast per group.
CUT_BUDGET = 65536
MAX_BUCKETS = 16384
# Size of the sketch of a column for each bucket; more than this many values per bucket change little.
SKETCH_PER_BUCKET, LEAST_SKETCH, LARGEST_SKETCH = 4, 256, 65535
COLUMNS_PER_STACK = 100


def stacked(df: DataFrame, keys: list[str], columns: dict[str, list[Column]], names: list[str]) -> DataFrame:
    """Long form: one row per (row, feature), with the given value columns.

    Wide tables are stacked some columns at a time, as more would outgrow compiled
    code; each part reads only its own columns.
    """
    def some(part: list[str]) -> DataFrame:
        args = [arg for feature in part for arg in (F.lit(feature), *columns[feature])]
        return df.select(*(col(k) for k in keys), F.stack(F.lit(len(part)), *args).alias("feature", *names))

    features = list(columns)
    parts = [
        some(features[i : i + COLUMNS_PER_STACK]) for i in range(0, len(features), COLUMNS_PER_STACK)
    ]
    # Never NULL, but saying so gives all uses of the table, joined or not, the same plan,
    # and with it one shared shuffle.
    return reduce(DataFrame.unionByName, parts).filter(F.col("feature").isNotNull())


def _number(name: str) -> Column:
    # Adding zero turns -0.0 into 0.0; the two compare equal but are ordered apart by buckets.
    return col(name).cast("double") + F.lit(0.0)


def bucket_cuts(df: DataFrame, values: list[str]) -> dict[str, list[float]]:
    """Cut points per column at its quantiles. One pass, in which a task leaves a sketch of bounded size per column;
    the result is bounded by CUT_BUDGET. A value that fills several buckets is one cut."""
    # Four buckets per shuffle task: a cluster set up for more data gets finer cuts.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(16, min(MAX_BUCKETS, CUT_BUDGET // len(values), max(32, 4 * tasks)))
    probs = [i / buckets for i in range(1, buckets)]
    size = max(LEAST_SKETCH, min(LARGEST_SKETCH, SKETCH_PER_BUCKET * buckets))
    places = F.array(*(F.lit(p) for p in probs))
    cuts: dict[str, list[float]] = {}
    for at in range(0, len(values), COLUMNS_PER_STACK):
        # Some columns share an aggregate, which reads only those; more would outgrow compiled code.
        part = values[at:at + COLUMNS_PER_STACK]
        numbers = [_number(v) for v in part]
        present = [F.when(~F.isnan(x), x) for x in numbers]
        held = df.agg(
            *(F.count(x).alias(f"n{i}") for i, x in enumerate(present)),
            *(F.kll_sketch_agg_double(x, size).alias(f"s{i}") for i, x in enumerate(present)))
        # A sketch of no values has no quantiles.
        found = held.select(*(
            F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", places)).alias(f"q{i}") for i in range(len(part)))).first()
        cuts |= {v: sorted(set(found[f"q{i}"] or [])) for i, v in enumerate(part)}
    return {v: cuts[v] or [0.0] for v in values}


def cut_stacked(df: DataFrame, keys: list[str], cuts: dict[str, list[float]]) -> DataFrame:
    """Long form ``keys, feature, bucket, value`` of the present values.

    Bucket 0 lies below the first cut, bucket i from cut i-1 up to cut i, its upper end
    open. The search is binary and runs in the JVM.
    """
    ends = (float("-inf"), float("inf"))
    values = list(cuts)
    plain = df.select(*(col(k) for k in keys), *(_number(v).alias(f"__x{i}") for i, v in enumerate(values)))
    cutter = Bucketizer(
        inputCols=[f"__x{i}" for i in range(len(values))],
        outputCols=[f"__b{i}" for i in range(len(values))],
        splitsArray=[[ends[0], *(c for c in cuts[v] if c not in ends), ends[1]] for v in values],
        handleInvalid="keep",
    )
    columns = {
        v: [F.col(f"__b{i}").cast("int"), F.col(f"__x{i}")] for i, v in enumerate(values)
    }
    return stacked(cutter.transform(plain), keys, columns, ["bucket", "value"]).filter(
        F.col("value").isNotNull()
    )


def bucketed(
    df: DataFrame, keys: list[str], values: list[str], cuts: dict[str, list[float]] | None = None
) -> DataFrame:
    """Long form with buckets at sampled (or given) cuts."""
    return cut_stacked(df, keys, cuts or bucket_cuts(df, values))


def _wanted_ranks(probs: list[float], rows: Column) -> Column:
    """0-based places of the order statistics that the quantiles lie between."""
    def around(p: Column) -> Column:
        place = p * (rows - 1)
        return F.array(F.floor(place), F.ceil(place))

    return F.array_distinct(F.flatten(F.transform(F.lit(probs), around)))


def exact_quantiles(
    df: DataFrame,
    groups: list[str],
    values: list[str],
    probs: list[float],
    cuts: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Exact linear-interpolated quantiles: ``groups, feature, n, quantiles``.

    Two scans. Only rows of buckets that hold a wanted rank are shuffled: with
    deciles and 4096 buckets that is about half a percent of the values.
    """
    keys = [*groups, "feature"]
    long = bucketed(df, groups, values, cuts)
    for g in groups:
        long = long.filter(col(g).isNotNull())
    ordered = Window.partitionBy(*keys).orderBy("bucket")
    sizes = (
        long.groupBy(*keys, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
        .withColumn("before", F.sum("n").over(ordered) - F.col("n"))
    )
    ranks = _wanted_ranks(probs, F.col("total"))

    def hits(first: Column) -> Column:
        return F.filter(ranks, lambda r: (r >= first) & (r < first + F.col("n")))

    # At most two buckets per probability and (group, feature); lowest and highest
    # wanted place let most of a bucket's rows be passed over by plain comparisons.
    # Spark picks the join by their measured size, as the groups are the caller's.
    wanted = (
        sizes.withColumn("hits", hits(F.col("before")))
        .filter(F.size("hits") > 0)
        .select(*keys, "bucket", "before", "total", F.array_min("hits").alias("low"), F.array_max("hits").alias("high"))
    )
    carried = ("before", "total", "low", "high")
    near = (
        long.join(measured(wanted, "wanted"), [*keys, "bucket"])
        .groupBy(*keys, "bucket", "value")
        .agg(F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in carried))
    )
    inside = Window.partitionBy(*keys, "bucket").orderBy("value")
    found = (
        near.withColumn("first", F.col("before") + F.sum("n").over(inside) - F.col("n"))
        .filter((F.col("first") <= F.col("high")) & (F.col("first") + F.col("n") > F.col("low")))
        .select(*keys, "total", "value", F.explode(hits(F.col("first"))).alias("place"))
        .groupBy(*keys)
        .agg(
            F.first("total").alias("n"),
            F.map_from_entries(F.collect_list(F.struct("place", "value"))).alias("at"),
        )
    )

    def quantile(p: Column) -> Column:
        place = p * (F.col("n") - 1)
        low = F.element_at("at", F.floor(place))
        high = F.element_at("at", F.ceil(place))
        part = place - F.floor(place)
        # From the nearer end, so that a part just under one gives the upper value exactly.
        return F.when(part >= 0.5, high - (high - low) * (1.0 - part)).otherwise(low + (high - low) * part)

    return found.select(*keys, "n", F.transform(F.lit(probs), quantile).alias("quantiles"))


def _counts(df, groups, values, label, cuts):
    """Rows and positives of each distinct value: ``groups, feature, bucket, value, n, p``."""
    long = bucketed(df.filter(col(label).isNotNull()), [*groups, label], values, cuts)
    y = col(label).cast("bigint")
    return long.groupBy(*groups, "feature", "bucket", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum(y).alias("p")
    )


def rank_sums(
    df: DataFrame,
    groups: list[str],
    values: list[str],
    label: str,
    cuts: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Per group and feature: rows ``n``, positives ``p``, sum of the average ranks of
    the positives, and sum of all squared average ranks. One scan.
    """
    keys = [*groups, "feature"]
    counts = _counts(df, groups, values, label, cuts)
    inside = Window.partitionBy(*keys, "bucket").orderBy("value")
    n, p = F.col("n").cast("double"), F.col("p").cast("double")
    rank = F.sum("n").over(inside) - (F.col("n") - 1) / 2.0
    local = (
        counts.withColumn("r", rank)
        .groupBy(*keys, "bucket")
        .agg(
            F.sum("n").alias("n"),
            F.sum("p").alias("p"),
            F.sum(n * F.col("r")).alias("nr"),
            F.sum(p * F.col("r")).alias("pr"),
            F.sum(n * F.col("r") * F.col("r")).alias("nrr"),
        )
    )
    # One row per bucket from here on.
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy("bucket")) - F.col("n")
    shifted = local.withColumn("o", before.cast("double"))
    o = F.col("o")
    return shifted.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum("p").alias("p"),
        F.sum(F.col("pr") + o * p).alias("positive_rank_sum"),
        F.sum(F.col("nrr") + 2.0 * o * F.col("nr") + o * o * n).alias("rank_square_sum"),
    )


def auc_of(n: Column, p: Column, positive_rank_sum: Column) -> Column:
    """Area under the ROC curve, ties counted half; NULL when one class is absent."""
    p, n = p.cast("double"), n.cast("double")
    return ratio(positive_rank_sum - p * (p + 1.0) / 2.0, p * (n - p))


def spearman_of(n: Column, p: Column, positive_rank_sum: Column, rank_square_sum: Column) -> Column:
    """Rank correlation with a 0/1 label; NULL for a constant side.

    Ranks of a 0/1 label are a linear map of it, so the plain label will do.
    """
    p, n = p.cast("double"), n.cast("double")
    covariance = positive_rank_sum - p * (n + 1.0) / 2.0
    spread_x = rank_square_sum - n * (n + 1.0) * (n + 1.0) / 4.0
    spread_y = ratio(p * (n - p), n)
    # Rounding may leave a tiny nonzero spread where all values are tied.
    tied = spread_x <= n * n * n * 1e-13
    return F.when(~tied, ratio(covariance, F.sqrt(spread_x * spread_y)))


def ranked_metrics(df: DataFrame, groups: list[str], score: str, label: str) -> DataFrame:
    """``groups, samples, positive_count, auc, average_precision`` of one score, as ``auc`` and ``average_precision`` have
    them, from one shuffle of the rows: the totals of the buckets are counted before it and sent to them."""
    rows = df.filter(col(label).isNotNull())
    cuts = bucket_cuts(rows, [score])
    long = bucketed(rows, [*groups, label], [score], cuts).withColumn("y", col(label).cast("bigint"))
    sums = [F.count(F.lit(1)).alias("n"), F.sum("y").alias("p")]
    whole = Window.partitionBy(*groups)
    higher = whole.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    above = measured(long.groupBy(*groups, "bucket").agg(*sums).select(
        *(col(g).alias(f"__g{i}") for i, g in enumerate(groups)), F.col("bucket").alias("__bucket"),
        *(F.coalesce(F.sum(c).over(higher), F.lit(0)).alias(f"above_{c}") for c in ("n", "p")),
        *(F.sum(c).over(whole).alias(f"all_{c}") for c in ("n", "p"))), "above")
    inside = Window.partitionBy(*groups, "bucket").orderBy(F.desc("value"))
    local = long.groupBy(*groups, "bucket", "value").agg(*sums).select(
        *groups, "bucket", "n", "p", F.sum("n").over(inside).alias("cn"), F.sum("p").over(inside).alias("cp"))
    same = F.col("bucket") == F.col("__bucket")
    for i, g in enumerate(groups):
        same = same & col(g).eqNullSafe(F.col(f"__g{i}"))
    n, p, to_n, to_p = (F.col(c).cast("double") for c in ("n", "p", "cn", "cp"))
    to_n, to_p = to_n + F.col("above_n"), to_p + F.col("above_p")
    # Pairs of a positive and a negative that are in order, a tie counted half; recall gained times precision.
    found = local.join(above, same).groupBy(*groups).agg(
        F.first("all_n").alias("samples"), F.first("all_p").alias("positive_count"),
        F.sum((n - p) * (to_p - p / 2.0)).alias("ordered"), F.sum(ratio(p * to_p, F.col("all_p") * to_n)).alias("average_precision"))
    positive, negative = F.col("positive_count").cast("double"), (F.col("samples") - F.col("positive_count")).cast("double")
    return found.select(
        *groups, "samples", "positive_count", ratio(F.col("ordered"), positive * negative).alias("auc"), "average_precision")


def average_precision(
    df: DataFrame, groups: list[str], score: str, label: str
) -> DataFrame:
    """Average precision (step-wise area under precision-recall): sum over distinct
    scores, highest first, of the recall gained times the precision there.
    """
    keys = [*groups, "feature"]
    inside = Window.partitionBy(*keys, "bucket").orderBy(F.desc("value"))
    local = _counts(df, groups, [score], label, bucket_cuts(df, [score])).withColumn(
        "cn", F.sum("n").over(inside)).withColumn("cp", F.sum("p").over(inside))
    # A bucket's totals are those of its lowest value; the rows above it come from the totals alone.
    within = Window.partitionBy(*keys, "bucket")
    last = F.row_number().over(within.orderBy("value")) == 1
    whole = Window.partitionBy(*keys)
    totals = local.withColumn("last", last)
    above = totals.filter("last").select(
        *keys, "bucket",
        (F.sum("cn").over(whole.orderBy(F.desc("bucket"))) - F.col("cn")).alias("above_n"),
        (F.sum("cp").over(whole.orderBy(F.desc("bucket"))) - F.col("cp")).alias("above_p"),
        F.sum("cn").over(whole).alias("all_n"),
        F.sum("cp").over(whole).alias("all_p"),
    )
    joined = local.join(above, [*keys, "bucket"])
    precision = ratio((F.col("above_p") + F.col("cp")).cast("double"), (F.col("above_n") + F.col("cn")).cast("double"))
    recall = ratio(F.col("p").cast("double"), F.col("all_p").cast("double"))
    return joined.groupBy(*groups).agg(
        F.first("all_n").alias("samples"),
        F.first("all_p").alias("positive_count"),
        F.sum(recall * precision).alias("average_precision"),
    )
