"""Lineage cuts through reliable checkpoints in the folder that the cluster names."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local one only where none is set."""
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        context.setCheckpointDir(context.getConf().get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="docweave-checkpoints-"))
        current = context._jsc.sc().getCheckpointDir()
    return current.get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
