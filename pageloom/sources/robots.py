"""Captured robots files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_robots(spark: SparkSession, path: str) -> DataFrame:
    """``(netloc, http_status, body)``, one row per host; null status = unreachable."""
    return one_per_host(spark.read.parquet(path))


def one_per_host(robots: DataFrame) -> DataFrame:
    """Key by lower-cased host, scheme ignored; of copies the smallest is kept.

    A copy that got an answer counts before one that did not (null status).
    """
    return robots.groupBy(F.lower("netloc").alias("netloc")).agg(
        F.min(F.struct(F.col("http_status").isNull().alias("silent"), "http_status", "body")).alias("answer")
    ).select("netloc", "answer.http_status", "answer.body")
