"""Ship this package to the executors, where Python workers import it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def shipped(spark: SparkSession) -> SparkSession:
    """``spark``, whose executors can import the package; once for each context.

    Nothing is done where the package was itself started from an archive, as
    ``--py-files`` has then put it on every worker's path.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(context, "_docweave_shipped", False) or not package.is_dir():
        return spark
    archive = Path(tempfile.mkdtemp(prefix="docweave-")) / "docweave.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._docweave_shipped = True
    return spark
