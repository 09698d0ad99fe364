"""Small helpers the operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from tabsift.session import scratch_path

#: Characters that separate words: space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch; whole texts go to Python, so the default of 10,000 rows would be large.
BATCH_ROWS = 2_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: lineage ends here, executors may go."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(table: DataFrame) -> None:
    """Delete a table of ``staged`` from which nothing is read any more, also not to make a lost part of a later one."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.staged_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def nullable(schema: StructType) -> StructType:
    """The schema with every column nullable: literals alone would not be."""
    return StructType([StructField(f.name, f.dataType, True) for f in schema.fields])


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch for jobs that move whole texts; a smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))


def words_in(text: Column) -> Column:
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def read_bytes(path: str) -> bytes:
    """A vocabulary file, read on the driver; its bytes travel with the tasks."""
    with open(os.fspath(path), "rb") as file:
        return file.read()


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one holds about ``limit`` bytes of text, or a single longer row."""
    for batch in batches:
        at = batch.schema.get_field_index(text)
        begun = held = 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(at)), 0).to_numpy()
        for row, length in enumerate(lengths):
            if held and held + length > limit:
                yield batch.slice(begun, row - begun)
                begun, held = row, 0
            held += int(length)
        if begun < batch.num_rows:
            yield batch.slice(begun)
