"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(name: str = "tabsift", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume: UTC, AQE, no web page."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Call sites in error texts cost a stack walk per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="tabsift-")
    spark.conf.set("tabsift.local.scratch", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for one intermediate table."""
    base = spark.conf.get("tabsift.local.scratch", None) or shared_dir(spark)
    return f"{base}/tabsift/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Reliable checkpoint below the shared folder: survives the loss of executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoint"))
    return df.checkpoint()
