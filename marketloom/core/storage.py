"""Rows kept in reliable storage, so that a query reads its source once and a lost executor replays nothing."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="spark-checkpoint-")


def kept(df: DataFrame) -> DataFrame:
    """The rows of ``df``, worked out now and read from storage from here on.  A streaming frame is left as it is."""
    if df.isStreaming:
        return df
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
