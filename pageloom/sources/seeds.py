"""Start URLs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import strip
from ..functions.urls import get_domain

SEEDS = "url string, seq bigint"
_URLS_PER_LIST = 2**31  # an array cannot hold more


def seeds(spark: SparkSession, urls: str | Iterable[str]) -> DataFrame:
    """``(url, depth, seq)`` from a list or a comma-separated text; URLs kept as given."""
    if isinstance(urls, str):
        return seed_lists(spark.createDataFrame([(0, urls)], "line bigint, urls string"))
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], SEEDS)
    return df.select("url", F.lit(0).alias("depth"), "seq")


def seed_lists(lists: DataFrame) -> DataFrame:
    """``(url, depth, seq)`` of many comma-separated texts ``(line, urls)``, in order of lines."""
    parts = lists.select(
        "line",
        F.posexplode(
            F.filter(F.transform(F.split("urls", ","), strip), lambda u: u != "")
        ).alias("pos", "url"),
    )
    seq = F.col("line").cast("bigint") * _URLS_PER_LIST + F.col("pos")
    return parts.select("url", F.lit(0).alias("depth"), seq.alias("seq"))


def root_domains(seed_urls: DataFrame) -> DataFrame:
    """Distinct hosts of the seeds as ``root``."""
    return seed_urls.select(get_domain(F.col("url")).alias("root")).distinct()
