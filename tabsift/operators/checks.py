"""Data checks and profiling.

A check is a row ``(check, severity, ok, observed, expected)``; ``require``
turns failing error rows into an exception.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabsift.functions.columns import col
from tabsift.operators.cleaning import COLUMNS_PER_AGGREGATE
from tabsift.roles import Roles, Windows, date_bound, month_of

CHECK_SCHEMA = "check string, severity string, ok boolean, observed string, expected string"


class DataCheckError(ValueError):
    """A required data check failed."""


def _row(check: str, severity: Column, ok: Column, observed: Column, expected: str) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        severity.alias("severity"),
        ok.alias("ok"),
        observed.cast("string").alias("observed"),
        F.lit(expected).alias("expected"),
    )


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key; NULL keys equal each other."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def check_duplicates(df: DataFrame, roles: Roles) -> DataFrame:
    """Repeats over ids and target; the date is not part of the key."""
    found = duplicate_count(df, [*roles.ids, roles.target])
    n = F.col("duplicates")
    return found.select(F.inline(F.array(_row("duplicates", F.lit("error"), n == 0, n, "0"))))


def check_binary_target(df: DataFrame, target: str) -> DataFrame:
    """Exactly two distinct non-null values, and no null target."""
    found = (
        df.groupBy(col(target).alias("y"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count("y").alias("distinct"),
            F.coalesce(F.sum(F.when(F.col("y").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        )
    )
    rows = F.array(
        _row("binary_target", F.lit("error"), F.col("distinct") == 2, F.col("distinct"), "2"),
        _row("null_target", F.lit("error"), F.col("nulls") == 0, F.col("nulls"), "0"),
    )
    return found.select(F.inline(rows))


def check_coverage(df: DataFrame, date: str, windows: Windows) -> DataFrame:
    """Train window inside the date range; out-of-time data there, at least in part."""
    bound = lambda value: date_bound(df, date, value)
    if isinstance(df.schema[date].dataType, T.StringType):
        df = df.select(F.to_timestamp(date).alias(date))
    spelled = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    lo, hi = F.col("lo"), F.col("hi")
    found = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    span = F.concat_ws(" .. ", spelled(lo), spelled(hi))
    rows = F.array(
        _row(
            "train_coverage", F.lit("error"),
            (lo <= bound(windows.train_start)) & (hi >= bound(windows.train_end)),
            span, f"{windows.train_start} .. {windows.train_end}",
        ),
        _row("oot_present", F.lit("error"), hi >= bound(windows.oot_start), spelled(hi), f">= {windows.oot_start}"),
        _row("oot_complete", F.lit("warning"), hi >= bound(windows.oot_end), spelled(hi), f">= {windows.oot_end}"),
    )
    return found.select(F.inline(rows)).withColumn("ok", F.coalesce("ok", F.lit(False)))


def bad_names(names: list[str]) -> list[str]:
    """Names that are not letters, digits and underscores with at least one letter or digit."""
    return [n for n in names if not n.replace("_", "").isalnum()]


def check_names(df: DataFrame) -> DataFrame:
    """Column names come from the schema; no job runs."""
    bad = bad_names(df.columns)
    return df.sparkSession.createDataFrame(
        [("column_names", "error", not bad, ", ".join(bad), "letters, digits, underscores")],
        CHECK_SCHEMA,
    )


def check_required(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    return df.sparkSession.createDataFrame(
        [("required_columns", "error", not missing, ", ".join(missing), ", ".join(required))],
        CHECK_SCHEMA,
    )


def data_checks(df: DataFrame, roles: Roles, windows: Windows) -> DataFrame:
    """All checks as one table."""
    parts = [
        check_duplicates(df, roles),
        check_binary_target(df, roles.target),
        check_coverage(df, roles.date, windows),
        check_names(df),
        check_required(df, [roles.date, roles.target]),
    ]
    return reduce(DataFrame.unionByName, parts)


def require(checks: DataFrame) -> list:
    """Raise on the first failing error row; return the failing warnings."""
    failed = checks.filter(~F.col("ok")).collect()
    for row in failed:
        if row["severity"] == "error":
            raise DataCheckError(f"{row['check']}: found {row['observed']!r}, expected {row['expected']!r}")
    return failed


def null_profile(df: DataFrame) -> DataFrame:
    """Missing values per column, one output row per column. A hundred columns share an aggregate, which reads only
    those; more would outgrow compiled code."""
    def some(part: list[str]) -> DataFrame:
        counts = df.agg(
            F.count(F.lit(1)).alias("__rows"), *(F.count(col(c)).alias(f"c{i}") for i, c in enumerate(part))
        )
        rows = F.array(
            *(
                F.struct(F.lit(c).alias("column_name"), (F.col("__rows") - F.col(f"c{i}")).alias("n_null"))
                for i, c in enumerate(part)
            )
        )
        return counts.select(F.inline(rows))

    names = df.columns
    return reduce(DataFrame.unionByName, (
        some(names[i : i + COLUMNS_PER_AGGREGATE]) for i in range(0, len(names), COLUMNS_PER_AGGREGATE)))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Frequency of each present value, most frequent first."""
    return (
        df.filter(col(name).isNotNull())
        .groupBy(col(name).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def head_per_group(
    df: DataFrame, key: str | Column, n: int, order_by: list[str], salts: int = 64
) -> DataFrame:
    """First ``n`` rows of each group in the given order.

    Two steps: the first ``n`` of each (group, salt), then of each group. Spark
    keeps only ``n`` rows per window group before the first shuffle, and a group
    that holds a third of the table is spread over ``salts`` tasks.
    """
    group = key if isinstance(key, Column) else col(key)
    order = [col(c).asc_nulls_last() for c in order_by]
    tagged = df.withColumn("__group", group).withColumn(
        "__salt", F.pmod(F.xxhash64(*order_by), F.lit(salts))
    )

    def first(rows: DataFrame, *by: str) -> DataFrame:
        at = Window.partitionBy(*by).orderBy(*order)
        return rows.withColumn("__at", F.row_number().over(at)).filter(F.col("__at") <= n)

    kept = first(first(tagged, "__group", "__salt").drop("__at"), "__group")
    return kept.drop("__group", "__salt", "__at")


def monthly_statistics(df: DataFrame, roles: Roles) -> DataFrame:
    """Rows, positives and positive rate per month."""
    y = col(roles.target)
    return df.groupBy(month_of(roles.date).alias("month")).agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum(y).cast("bigint").alias("positive_count"),
        F.avg(y).alias("positive_rate"),
    )


