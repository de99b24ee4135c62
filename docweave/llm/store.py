"""Lineage cuts: intermediate tables in the shared folder of the cluster.

``written`` stores a DataFrame as Parquet under ``spark.checkpoint.dir`` and
rereads it, so later stages neither recompute nor depend on the executors that
produced it.  The folder comes from the session; only where none is set (tests)
a local one is made.  Results read such tables when they are computed; ``clear``
deletes all tables of the application once its results are written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for lineage cuts, from the session where it names one."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named is None:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        named = "file://" + tempfile.mkdtemp(prefix="docweave-checkpoints-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` stored as Parquet in the shared folder, and reread from there."""
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/docweave-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete the tables that this application has written; results that still read them can't be computed again."""
    _delete(spark, _own_folder(spark))


def discard(df: DataFrame) -> None:
    """Delete the files behind a table made by ``written`` once it is not needed."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rpartition("/")[0])
