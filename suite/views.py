"""Example tables with known good and bad features, built from the star schema.

The given tables carry almost no signal, so these views plant some: columns that
predict the label, drift, are constant, sparse or noise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabsift.roles import Roles, Windows, date_bound, month_of
from tabsift.sources.tables import read_table

RISK = Roles(ids=("risk_id",), target="label", date="partition_date")
WINDOWS = Windows("1995-01-01", "2000-12-31", "2001-01-01", "2001-08-01")
LINES = Roles(ids=("l_orderkey", "l_linenumber"), target="label", date="partition_date", ignored=("score",))
LINE_WINDOWS = Windows("1995-01-01", "2000-12-31", "2001-01-01", "2002-12-31")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def risk_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order: price, balance, line sums, planted drift, and a 0/1 label."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    # Whole cents are summed, so that the mean does not depend on the order of rows.
    lines = (
        table(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("l_quantity").alias("sum_qty"),
            F.sum(F.rint(F.col("l_discount") * 100.0)).alias("cents"),
        )
    )
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    late = F.col("o_orderdate") >= date_bound(orders, "o_orderdate", "2001-01-01")
    positive = (price > 250000) != (key % 5 == 0)
    label = F.when(positive, 1).otherwise(0)
    signal = F.when(positive, F.when(key % 3 == 0, "A").otherwise("B")).otherwise(
        F.when(key % 3 == 1, "A").otherwise("C")
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(lines, F.col("l_orderkey") == key, "left")
        .select(
            key.alias("risk_id"),
            F.col("o_orderdate").alias("partition_date"),
            label.alias("label"),
            price.alias("total_price"),
            F.col("c_acctbal").alias("acctbal"),
            F.col("n").cast("int").alias("n_lines"),
            "sum_qty",
            (F.col("cents") / (F.col("n") * 100.0)).alias("avg_disc"),
            (price * F.when(late, 0.5).otherwise(1.0)).alias("drift_half"),
            (price * F.when(late & (key % 3 != 0), 0.4).otherwise(1.0)).alias("drift_some"),
            (price * F.when(late, 1.5).otherwise(1.0)).alias("drift_up"),
            F.lit(1.0).alias("const_col"),
            F.when(key % 20 == 0, price).alias("sparse_col"),
            signal.alias("seg_signal"),
            F.col("o_orderpriority").alias("priority"),
            F.col("c_mktsegment").alias("segment"),
        )
    )


def scored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per line with a 0/1 label and a score with many ties that rises with it."""
    returned = F.col("l_returnflag") == "R"
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_shipdate").alias("partition_date"),
        F.when(returned, 1).otherwise(0).alias("label"),
        ((F.col("l_quantity") / 50.0 + F.when(returned, 0.2).otherwise(0.0)) / 1.2).alias("score"),
        "l_quantity", "l_discount", "l_extendedprice",
    )


def gappy_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The scored lines, every seventh order without a score."""
    lines = scored_lines(spark, sf)
    return lines.withColumn("score", F.when(F.col("l_orderkey") % 7 != 0, F.col("score")))


def scored_months(spark: SparkSession, sf: str) -> DataFrame:
    return scored_lines(spark, sf).withColumn("month", month_of("partition_date"))


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a quality label: length, language and source as features."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    documents = table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return documents.join(labels, "doc_id")


def two_scores(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The same order score twice: exact from the orders, and in steps of 0.01 from
    the orders that have lines."""
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), (F.col("o_totalprice") / 500000.0).alias("score")
    )
    with_lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")).distinct()
    coarse = orders.join(with_lines, "id", "left_semi").select(
        "id", (F.floor(F.col("score") * 100.0) / 100.0).alias("score")
    )
    return orders, coarse


def stream_events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value"
    )
