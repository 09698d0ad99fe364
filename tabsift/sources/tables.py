"""Reading tables and describing them.

Object stores are read through their Hadoop connector (``s3a://bucket/key``);
endpoint and credentials belong to the session's ``spark.hadoop.fs.s3a.*``
settings and are neither taken nor printed here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN and NULL both mean missing; keep only NULL so that aggregates skip it."""
    return df.select(
        *(
            F.nullif(F.col(f"`{f.name}`"), F.lit(float("nan")).cast(f.dataType)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table; a missing path raises AnalysisException at once.

    Values come as they are, so that filters on them reach the files; ``nan_to_null`` belongs before statistics.
    """
    return spark.read.parquet(path)


def read_columns(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """The named columns (default: all); the others are never read from the files."""
    df = spark.read.parquet(path)
    return df if names is None else df.select(*(f"`{c}`" for c in names))


def table_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, columns of that type, table shape.

    The row count needs no column data; the names come from the schema.
    """
    kinds = [f.dataType.simpleString() for f in df.schema.fields]
    columns = F.array(
        *(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("dtype"),
                F.lit(kinds.count(kind)).alias("columns_of_dtype"),
            )
            for i, (name, kind) in enumerate(zip(df.columns, kinds))
        )
    )
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("n_columns", F.lit(len(kinds)))
        .select(F.inline(columns), "n_rows", "n_columns")
    )
