"""Row filters, the time split, samples, and putting splits together again."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabsift.functions.columns import col
from tabsift.roles import Roles, Windows, month_of, within

# Digits of a hash that are counted at once, and rows that are put in order without a further level.
PREFIX_DIGITS, ORDERED_ROWS = 4, 4096


def split_by_date(df: DataFrame, date: str, windows: Windows) -> DataFrame:
    """Tag rows ``train`` or ``oot``; rows in neither window are dropped.

    Both ends are closed at midnight. One scan: the windows are one filter that
    reaches the files. Only overlapping windows give a row twice.
    """
    train = within(df, date, windows.train_start, windows.train_end)
    oot = within(df, date, windows.oot_start, windows.oot_end)
    rows = df.filter(train | oot)
    if not windows.overlap:
        return rows.withColumn("split", F.when(train, "train").otherwise("oot"))
    tags = F.array_compact(F.array(F.when(train, F.lit("train")), F.when(oot, F.lit("oot"))))
    return rows.withColumn("split", F.explode(tags))


def union_splits(train: DataFrame, oot: DataFrame) -> DataFrame:
    """Two separate tables as one, tagged by origin."""
    return train.withColumn("split", F.lit("train")).unionByName(
        oot.withColumn("split", F.lit("oot"))
    )


def between_dates(df: DataFrame, date: str, start: str, end: str) -> DataFrame:
    """Rows of a closed date range."""
    return df.filter(within(df, date, start, end))


def by_month(df: DataFrame, roles: Roles) -> DataFrame:
    """Month column for grouping; rows without a date belong to no month."""
    return df.filter(col(roles.date).isNotNull()).withColumn("month", month_of(roles.date))


def group_sizes(df: DataFrame, group: str, label: str, more_than: int = 10) -> DataFrame:
    """Rows and label values per group, with an error text for groups too small to judge."""
    sizes = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("samples"),
        (F.max(label) != F.min(label)).alias("varies"),
    )
    fit = (F.col("samples") > more_than) & F.coalesce("varies", F.lit(False))
    return sizes.select(
        group, "samples",
        F.when(~fit, F.lit("Insufficient data or no label variance")).alias("error"),
    )


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``keys``: the same rows on any cluster.

    Off by default everywhere. ``keys`` should identify a row. Rows are counted by the first digits of their hash, and the
    digits of the ``n``-th are found level by level; whole prefixes before it are taken by a filter, and only the few
    rows that share its digits are put in order. No task sees more than its share of the ``n`` rows.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *(col(k).cast("string") for k in keys)))
    hashed = df.withColumn("__hash", digest)
    before, prefix = 0, ""
    while True:
        level = hashed.filter(F.col("__hash").startswith(prefix)).groupBy(
            F.substring("__hash", 1, len(prefix) + PREFIX_DIGITS).alias("digits")).count()
        counts = sorted(map(tuple, level.collect()))  # 16^PREFIX_DIGITS rows at most
        if before + sum(c for _, c in counts) <= n:
            return df  # only at the first level: later ones hold the n-th row
        for digits, count in counts:
            if before + count > n:
                break
            before += count
        prefix = digits
        if count <= ORDERED_ROWS or len(prefix) == 32:
            break
    sure = hashed.filter(F.col("__hash") < prefix)
    last = hashed.filter(F.col("__hash").startswith(prefix)).orderBy("__hash", *(col(k) for k in keys)).limit(n - before)
    return sure.unionByName(last).drop("__hash")
