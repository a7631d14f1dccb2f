"""Captured responses as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..schema import FETCH, with_defaults


def read_fetches(spark: SparkSession, path: str) -> DataFrame:
    """Fetch log written with the fetch schema, Parquet."""
    return spark.read.schema(FETCH).parquet(path)


def save_fetches(fetches: DataFrame, table: str, buckets: int) -> DataFrame:
    """Store a large fetch log in buckets by URL, sorted, and return the table.

    A traversal joins every level with it; in this layout only the level's URLs move.
    """
    (
        fetches.write.mode("overwrite")
        .bucketBy(buckets, "url")
        .sortBy("url")
        .saveAsTable(table)
    )
    return fetches.sparkSession.table(table)


def spread_small(df: DataFrame, *keys: str) -> DataFrame:
    """Give every core work when the input has fewer splits than the session has cores.

    One exchange of a small input; anything with enough splits passes through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores, *keys)


def fetches_from_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, html)`` captures as successful HTML fetches; ``seq`` = id."""
    return pages.select(
        F.col("page_id").alias("seq"),
        "url",
        F.lit(200).alias("status_code"),
        F.lit("text/html").alias("content_type"),
        F.col("html").alias("body"),
        F.lit("").alias("fetched_at"),
        F.lit(None).cast("string").alias("error"),
    )


def records_from_documents(documents: DataFrame) -> DataFrame:
    """Plain ``(doc_id, text)`` documents as one-paragraph records."""
    return with_defaults(
        documents.select(
            F.col("doc_id").alias("seq"),
            F.concat(F.lit("doc:"), F.col("doc_id")).alias("url"),
            F.array("text").alias("paragraphs"),
        ),
        "seq",
    )
