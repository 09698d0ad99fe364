import datetime as dt

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tabsift import Roles, Windows
from tabsift.operators import checks, cleaning, splitting
from tabsift.sources import nan_to_null, read_columns, read_stage, read_table, write_stage

ROLES = Roles(("id",), "label", "day")
WINDOWS = Windows("2024-01-01", "2024-08-31", "2024-09-01", "2024-09-30")


def one(df):
    return df.collect()[0]


def test_windows_are_checked():
    with pytest.raises(ValueError):
        Windows("2024-01-01", "2024-08-31", "2024-09-01", "2024-09-31")
    with pytest.raises(ValueError):
        Windows("2024-02-01", "2024-01-01", "2024-09-01", "2024-09-30")


def test_missing_table_raises(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_table(spark, str(tmp_path / "none.parquet"))


def test_named_columns_prune_the_scan(spark, sf):
    df = read_columns(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.columns == ["l_orderkey", "l_partkey"] and "l_shipdate" not in plan


def test_float_filters_reach_the_files(spark, sf):
    df = read_table(spark, f"{sf}/orders.parquet").filter("o_totalprice > 400000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_totalprice" in plan


def test_nan_is_missing(spark):
    df = nan_to_null(spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, i int"))
    assert one(df.agg(F.count("x").alias("n"), F.avg("x").alias("m"))) == (1, 2.0)


def test_date_filter_reaches_the_files(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    rows = splitting.split_by_date(orders, "o_orderdate", Windows("1995-01-01", "2000-12-31", "2001-01-01", "2001-08-01"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_duplicates_are_null_safe(spark):
    rows = [(1, 0), (1, 0), (1, 1), (None, 0), (None, 0), (None, 0)]
    df = spark.createDataFrame(rows, "id int, label int").withColumn("day", F.lit("2024-01-01"))
    assert one(checks.duplicate_count(df, ["id", "label"]))[0] == 3
    assert not one(checks.check_duplicates(df, ROLES))["ok"]


def test_names():
    assert checks.bad_names(["a-b", "___", "é", "a b", "ok_1"]) == ["a-b", "___", "a b"]


@pytest.mark.parametrize(
    "values, distinct, nulls",
    [([0, 1, 1], True, True), ([0, 0], False, True), ([0, 1, 2], False, True), ([0, 1, None], True, False)],
)
def test_binary_target(spark, values, distinct, nulls):
    df = spark.createDataFrame([(v,) for v in values], "label int")
    ok = {r["check"]: r["ok"] for r in checks.check_binary_target(df, "label").collect()}
    assert ok == {"binary_target": distinct, "null_target": nulls}


@pytest.mark.parametrize(
    "first, last, expected",
    [
        ("2024-01-01", "2024-09-30", (True, True, True)),
        ("2024-01-02", "2024-09-30", (False, True, True)),
        ("2023-12-01", "2024-09-10", (True, True, False)),
        ("2023-12-01", "2024-08-20", (False, False, False)),
    ],
)
def test_coverage(spark, first, last, expected):
    for kind in ("string", "timestamp", "timestamp_ntz", "date"):
        df = spark.createDataFrame([(first,), (last,)], "day string").withColumn("day", F.col("day").cast(kind))
        rows = checks.check_coverage(df, "day", WINDOWS).collect()
        assert tuple(r["ok"] for r in rows) == expected, kind


def test_require(spark):
    schema = checks.CHECK_SCHEMA
    bad = spark.createDataFrame([("a", "error", False, "1", "0")], schema)
    warning = spark.createDataFrame([("a", "warning", False, "1", "0")], schema)
    with pytest.raises(checks.DataCheckError):
        checks.require(bad)
    assert len(checks.require(warning)) == 1


def test_head_per_group_of_a_hot_group(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.xxhash64("id").alias("v"), "id",
    )
    got = checks.head_per_group(df, "k", 7, ["v"]).toPandas()
    want = df.toPandas().sort_values("v").groupby("k").head(7)
    assert sorted(got["id"]) == sorted(want["id"]) and list(got.columns) == ["k", "v", "id"]


def test_drop_constant(spark):
    df = spark.createDataFrame(
        [(i, 0, "d", 0.1, None, 5 if i else None, float(i)) for i in range(7)],
        "id int, label int, day string, tenth double, empty double, once int, varies double",
    ).withColumn("once", F.when(F.col("id") == 1, 5))
    assert cleaning.drop_constant(df, ROLES).columns == ["id", "label", "day", "empty", "once", "varies"]


def test_rounding_equals_numpy(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(0, 1000, 3000), np.arange(-200, 200) / 8.0, [2.675, 1.005, -0.125, 1e15 + 0.3]])
    df = spark.createDataFrame([(0, 0, "d", float(v)) for v in values], "id int, label int, day string, x double")
    got = np.array([r["x"] for r in cleaning.round_features(df, ROLES).select("x").collect()])
    assert (got == np.round(values, 2)).all()


def test_fill_leaves_fixed_columns(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, None)], "id int, label int, day string, x double, b tinyint, s string"
    )
    row = one(cleaning.fill_sentinel(df, ROLES))
    assert tuple(row) == (None, None, None, -999999.0, -999999, "missing")


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 127, 40000, 2**40, 1.5), (2, -5, -40000, 1, 2.5)], "a long, b long, c long, d long, e double")
    kinds = dict(cleaning.narrow_types(df).dtypes)
    assert kinds == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "float"}


def test_align(spark):
    df = spark.createDataFrame([(1, None, 9.0)], "id int, a double, extra double")
    assert tuple(one(cleaning.align_features(df, ["b", "a"], ["id"]))) == (1, 0, -999999.0)


def test_impute_median(spark):
    rows = [("train", 1.0), ("train", 2.0), ("train", 10.0), ("train", None), ("oot", 4.0), ("oot", 6.0), ("oot", None)]
    df = spark.createDataFrame(rows, "split string, x double")
    got = sorted((r["split"], r["x"]) for r in cleaning.impute_median(df, ["x"]).collect())
    assert ("oot", 5.0) in got and got.count(("train", 2.0)) == 2


def test_category_codes_follow_the_order(spark):
    values = [f"v{i % 997:04d}" for i in range(5000)] + ["a", None, "z", "é"] + ["hot"] * 3000
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, s string").repartition(8)
    got = {r["id"]: r["s"] for r in cleaning.factorize(df, ["s"]).collect()}
    order = {v: i for i, v in enumerate(sorted({v or "missing" for v in values}, key=lambda v: v.encode()))}
    assert got == {i: order[v or "missing"] for i, v in enumerate(values)}


def test_bad_dates(spark):
    df = spark.createDataFrame([("2024-01-05",), ("soon",)], "day string")
    assert cleaning.to_datetime(df, "day", lenient=True).filter("day is null").count() == 1
    with pytest.raises(Exception):
        cleaning.to_datetime(df, "day").collect()


def test_split_bounds(spark):
    days = ["2023-12-31", "2024-01-01", "2024-08-31 00:00:00", "2024-08-31 10:00:00", "2024-09-01", "2024-09-30", "2024-10-01"]
    df = spark.createDataFrame([(d,) for d in days], "t string").select(F.to_timestamp("t").alias("day"))
    got = splitting.split_by_date(df, "day", WINDOWS).orderBy("day").collect()
    assert [(r["day"].date().isoformat(), r["split"]) for r in got] == [
        ("2024-01-01", "train"), ("2024-08-31", "train"), ("2024-09-01", "oot"), ("2024-09-30", "oot"),
    ]
    both = Windows("2024-01-01", "2024-09-15", "2024-09-01", "2024-09-30")
    assert splitting.split_by_date(df, "day", both).filter("split = 'train'").count() == 4
    assert splitting.split_by_date(df, "day", both).filter("split = 'oot'").count() == 2


def test_sample_is_the_same_after_repartition(spark):
    df = spark.range(20000)
    a = {r[0] for r in splitting.sample_rows(df, 300, ["id"]).collect()}
    b = {r[0] for r in splitting.sample_rows(df.repartition(13), 300, ["id"]).collect()}
    assert len(a) == 300 and a == b
    assert splitting.sample_rows(df.limit(50), 300, ["id"]).count() == 50


def test_stage_keeps_rows(spark, tmp_path):
    df = spark.range(100).withColumn("split", F.when(F.col("id") < 90, "train").otherwise("oot"))
    write_stage(df, str(tmp_path / "s"))
    back = read_stage(spark, str(tmp_path / "s"))
    assert back.filter("split = 'oot'").count() == 10
    plan = back.filter("split = 'oot'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_group_sizes(spark):
    rows = [("big", i % 2) for i in range(20)] + [("flat", 1)] * 20 + [("small", i % 2) for i in range(10)]
    got = {r["g"]: r["error"] for r in splitting.group_sizes(spark.createDataFrame(rows, "g string, y int"), "g", "y").collect()}
    assert got["big"] is None and got["flat"] and got["small"]


def test_date_types_compare(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),)], "day date")
    assert splitting.between_dates(df, "day", "2024-03-01", "2024-03-02").count() == 1
