"""Stored intermediate tables, and the package's way to the executors."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def stage_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where unset, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    return folder.rstrip("/")


# Spark's setting by which a query's shuffle files go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the files.

    The files end the lineage: a lost executor costs only the tasks that were running.
    The shuffle files of the write are deleted with its end, not when the driver happens to
    collect its garbage, so those of several stages do not lie on disk together.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/llm/{uuid.uuid4().hex}-{name}"
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package: Spark sends them a zip of its sources.

    Once per application. The zip lies in a folder of the driver and is served by Spark.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    path = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(path, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(application)
