"""Captured pages parsed once and stored in buckets by URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.fetchlog import classify_fetch
from ..operators.pages import parse_pages
from ..schema import RECORD_FIELDS
from .stages import BucketedTable

_FETCH_FIELDS = ("url", "status_code", "content_type", "body", "fetched_at", "error")


class PageGraph:
    """The records of all captured pages, one per URL, in buckets by URL.

    A traversal reads ``url``, ``error`` and ``internal_links`` of it, level by level; the
    other columns are read once, for the pages it has visited. One graph serves any number
    of traversals. ``strict_status`` decides which responses are failures, as in
    :func:`~pageloom.operators.fetchlog.classify_fetch`.
    """

    def __init__(self, fetches: DataFrame, strict_status: bool = True, buckets: int | None = None):
        self.table = BucketedTable(fetches.sparkSession, "pages", "url", buckets)
        captured = fetches.select(*_FETCH_FIELDS).filter("url IS NOT NULL")
        self.table.append(parse_pages(classify_fetch(captured, strict_status)))
        pages = self.table.rows()
        repeated = pages.groupBy("url").agg(F.count("*").alias("n")).filter("n > 1")
        if not repeated.isEmpty():
            raise ValueError(
                "several responses for one URL; reduce them with collapse_attempts first"
            )

    @property
    def buckets(self) -> int:
        return self.table.buckets

    def states(self) -> DataFrame:
        """``url, captured, ok, fetched_at`` of every captured page."""
        return self.table.rows().select(
            "url", F.lit(True).alias("captured"), F.col("error").isNull().alias("ok"), "fetched_at"
        )

    def links(self) -> DataFrame:
        """``url, internal_links`` of the successful pages."""
        return self.table.rows().filter("error IS NULL").select("url", "internal_links")

    def records(self) -> DataFrame:
        """All records; ``depth`` is left to the traversal."""
        return self.table.rows().select(*(f for f in RECORD_FIELDS if f != "depth"))
