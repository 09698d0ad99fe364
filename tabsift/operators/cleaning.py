"""Projection and cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabsift.functions.columns import col, round_half_even
from tabsift.operators.ranking import exact_quantiles
from tabsift.roles import Roles
from tabsift.session import cut_lineage
from tabsift.sources.sinks import measured

# What missing numbers and missing text become.
SENTINEL = -999999
MISSING_TEXT = "missing"

# Integer types from narrow to wide with their bounds.
INTEGER_RANGES = [
    ("tinyint", -(2**7), 2**7 - 1),
    ("smallint", -(2**15), 2**15 - 1),
    ("int", -(2**31), 2**31 - 1),
]
FLOAT_MAX = 3.4028234663852886e38
COLUMNS_PER_AGGREGATE = 100
# Codes of one column that are sent to all tasks, and parts a value's rows are dealt into beyond that.
SMALL_CODES = 20_000
SALTS = 16


def select_roles(df: DataFrame, roles: Roles) -> DataFrame:
    """Ids, target, date and every column not ignored, in table order."""
    fixed = set(roles.fixed)
    return df.select(*(col(c) for c in df.columns if c in fixed or c not in roles.ignored))


def keep_features(df: DataFrame, roles: Roles, selected: list[str]) -> DataFrame:
    """Ids, target, date and the selected features (and the split tag if there)."""
    tag = ["split"] if "split" in df.columns else []
    return df.select(*(col(c) for c in [*roles.fixed, *tag, *selected]))


def to_datetime(df: DataFrame, date: str, lenient: bool = False) -> DataFrame:
    """Parse a text date; bad text raises unless ``lenient`` turns it into NULL."""
    if not isinstance(df.schema[date].dataType, T.StringType):
        return df
    parse = F.try_to_timestamp if lenient else F.to_timestamp
    return df.withColumn(date, parse(col(date)))


def _min_max(df: DataFrame, names: list[str]) -> DataFrame:
    """One row per column: present values and whether they are all equal.

    A hundred columns share an aggregate; more would outgrow compiled code. Each
    aggregate reads only its own columns.
    """
    def some(part: list[str]) -> DataFrame:
        aggs = df.agg(
            *(
                F.struct(
                    F.count(col(c)).alias("n"),
                    (F.min(col(c)) == F.max(col(c))).alias("constant"),
                ).alias(f"c{i}")
                for i, c in enumerate(part)
            )
        )
        rows = F.array(
            *(
                F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}.n"), F.col(f"c{i}.constant"))
                for i, c in enumerate(part)
            )
        )
        return aggs.select(F.inline(rows))

    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, n bigint, constant boolean")
    parts = [some(names[i : i + COLUMNS_PER_AGGREGATE]) for i in range(0, len(names), COLUMNS_PER_AGGREGATE)]
    return reduce(DataFrame.unionByName, parts)


def constant_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns with one value in at least two rows; nulls do not count."""
    return _min_max(df, names).filter(F.col("constant") & (F.col("n") >= 2)).select("column_name")


def drop_constant(df: DataFrame, roles: Roles) -> DataFrame:
    """Drop constant numeric features. Runs one job, as the result's schema depends on it."""
    constant = [r[0] for r in constant_columns(df, roles.numeric(df)).collect()]
    return df.drop(*constant)


def _filled(df: DataFrame, name: str) -> Column:
    """The column without missing values; NaN counts as missing, as in tables that were read and cleaned."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(F.nullif(col(name), F.lit(float("nan")).cast(kind)), F.lit(SENTINEL).cast(kind))
    if isinstance(kind, T.StringType):
        return F.coalesce(col(name), F.lit(MISSING_TEXT))
    if isinstance(kind, (T.ByteType, T.ShortType)):
        kind = T.IntegerType()  # the sentinel does not fit the narrow types
    elif isinstance(kind, T.DecimalType):
        kind = T.DoubleType()
    return F.coalesce(col(name).cast(kind), F.lit(SENTINEL).cast(kind))


def fill_sentinel(df: DataFrame, roles: Roles) -> DataFrame:
    """Missing numbers become the sentinel, missing text a word; fixed columns stay."""
    fill = {*roles.numeric(df), *roles.categorical(df)}
    return df.select(*(_filled(df, c).alias(c) if c in fill else col(c) for c in df.columns))


def round_features(df: DataFrame, roles: Roles, places: int = 2) -> DataFrame:
    """Round float features."""
    floats = {
        c for c in roles.numeric(df)
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType))
    }
    return df.select(
        *(
            round_half_even(col(c), places).cast(df.schema[c].dataType).alias(c)
            if c in floats
            else col(c)
            for c in df.columns
        )
    )


def narrow_plan(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Per numeric column: present type, range, and the narrowest type that holds it.

    Bounds are strict, so a column that reaches a type's own limit stays wider.
    """
    numeric = [
        f for f in df.schema.fields
        if isinstance(f.dataType, (T.IntegralType, T.FloatType, T.DoubleType))
        and (names is None or f.name in names)
    ]
    def target(i: int, kind: T.DataType) -> Column:
        lo, hi = F.col(f"c{i}.lo"), F.col(f"c{i}.hi")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            return F.when((lo > -FLOAT_MAX) & (hi < FLOAT_MAX), "float").otherwise(kind.simpleString())
        best = F.lit(kind.simpleString())
        widest = [n for n, *_ in INTEGER_RANGES] + ["bigint"]
        for name, low, high in reversed(INTEGER_RANGES):
            if widest.index(name) < widest.index(kind.simpleString()):
                best = F.when((lo > low) & (hi < high), name).otherwise(best)
        return best

    def some(part: list[T.StructField]) -> DataFrame:
        aggs = df.agg(
            *(F.struct(F.min(col(f.name)).alias("lo"), F.max(col(f.name)).alias("hi")).alias(f"c{i}")
              for i, f in enumerate(part))
        )
        rows = F.array(
            *(
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("from_type"),
                    F.col(f"c{i}.lo").cast("double").alias("min_value"),
                    F.col(f"c{i}.hi").cast("double").alias("max_value"),
                    target(i, f.dataType).alias("to_type"),
                )
                for i, f in enumerate(part)
            )
        )
        return aggs.select(F.inline(rows))

    if not numeric:
        return df.sparkSession.createDataFrame(
            [], "column_name string, from_type string, min_value double, max_value double, to_type string")
    parts = [some(numeric[i : i + COLUMNS_PER_AGGREGATE]) for i in range(0, len(numeric), COLUMNS_PER_AGGREGATE)]
    return reduce(DataFrame.unionByName, parts)


def narrow_types(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Cast each numeric column to its narrowest type. One job finds the ranges."""
    to = {r["column_name"]: r["to_type"] for r in narrow_plan(df, names).collect()}
    return df.select(*(col(c).cast(to[c]).alias(c) if c in to else col(c) for c in df.columns))


def align_features(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Model input: features in model order, absent ones 0, missing values filled."""
    def one(name: str) -> Column:
        if name not in df.columns:
            return F.lit(0).alias(name)
        if isinstance(df.schema[name].dataType, (T.NumericType, T.StringType)):
            return _filled(df, name).alias(name)
        return col(name)

    return df.select(*(col(c) for c in (keep or [])), *(one(f) for f in features))


def impute_median(df: DataFrame, names: list[str], by: str = "split") -> DataFrame:
    """Nulls become the exact median of the same column and group.

    The medians are one row per group; Spark picks the join by their measured size, as groups are the caller's.
    """
    medians = exact_quantiles(df, [by], names, [0.5])
    wide = medians.groupBy(by).agg(
        *(
            F.first(F.when(F.col("feature") == c, F.get("quantiles", F.lit(0))), ignorenulls=True).alias(f"__m{i}")
            for i, c in enumerate(names)
        )
    )
    at = {c: i for i, c in enumerate(names)}
    joined = df.join(measured(wide, "medians"), by, "left")
    return joined.select(
        *(
            F.coalesce(col(c).cast("double"), F.col(f"__m{at[c]}")).alias(c) if c in at else col(c)
            for c in df.columns
        )
    )


def category_codes(df: DataFrame, names: list[str]) -> DataFrame:
    """Integer code of each distinct text value in sorted order, per column.

    The distinct values are range-sorted across tasks and written to the shared
    folder; a value's code is its place in its file plus the sizes of the files
    before. No task holds a column's values as a whole.
    """
    pairs = F.array(
        *(F.struct(F.lit(c).alias("feature"), F.coalesce(col(c), F.lit(MISSING_TEXT)).alias("value")) for c in names)
    )
    distinct = df.select(F.inline(pairs)).distinct()
    kept = cut_lineage(distinct.orderBy("feature", "value")).select(
        "feature", "value",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
    )
    parts = kept.groupBy("feature", "part").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place")
    )
    before = Window.partitionBy("feature").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(
        "feature", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_place")).alias("start")
    )
    # One row per (feature, file): bounded by columns and files, not by rows.
    return kept.join(F.broadcast(starts), ["feature", "part"]).select(
        "feature", "value", (F.col("start") + F.col("place")).alias("code")
    )


def factorize(df: DataFrame, names: list[str], small: int = SMALL_CODES, salts: int = SALTS) -> DataFrame:
    """Replace text columns by their codes.

    The codes of a column are counted first. Up to ``small`` of them are sent to the rows, which then stay where
    they are. More are joined on the value and a salt, so that a value with very many rows is dealt out.
    """
    if not names:
        return df
    codes = category_codes(df, names)
    many = {r["feature"]: r["count"] for r in codes.groupBy("feature").count().collect()}
    out = df
    for c in names:
        mine = codes.filter(F.col("feature") == c).select(
            F.col("value").alias(f"__v_{c}"), F.col("code").alias(f"__c_{c}")
        )
        value = F.coalesce(col(c), F.lit(MISSING_TEXT))
        if many.get(c, 0) <= small:
            out = out.join(F.broadcast(mine), value == F.col(f"__v_{c}"), "left")
        else:
            # The salt hangs on the other columns of the row, so that a task run again deals alike.
            rest = [col(x) for x in df.columns if x != c]
            salt = F.pmod(F.xxhash64(*rest), F.lit(salts)) if rest else F.lit(0)
            spread = mine.withColumn(f"__s_{c}", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
            out = out.join(spread, (value == F.col(f"__v_{c}")) & (salt == F.col(f"__s_{c}")), "left")
    return out.select(*(F.col(f"__c_{c}").alias(c) if c in names else col(c) for c in df.columns))
