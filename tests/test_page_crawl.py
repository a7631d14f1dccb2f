"""The crawl queries over captured pages whose URLs repeat."""

import __spark_entry__ as registry

PAGES = [
    (3, "https://a.example/x", '<html><a href="/late">l</a></html>'),
    (1, "https://a.example/x", '<html><a href="/early">e</a></html>'),
    (2, "https://a.example/y", '<html><a href="/x">x</a></html>'),
    (2, "https://a.example/y", '<html><a href="/x">x</a></html>'),
]


def test_repeated_captures_are_visited_once(spark, tmp_path):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows.write.parquet(str(tmp_path / "pages.parquet"))
    found = registry.queries()["crawl_pages"](spark, str(tmp_path)).orderBy("seq").collect()
    assert [tuple(r) for r in found] == [
        (0, "https://a.example/x", 0, ""),
        (1, "https://a.example/y", 0, ""),
        (2, "https://a.example/early", 1, "not captured"),
    ]


def test_repeated_captures_are_repeated_seeds(spark, tmp_path):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows.write.parquet(str(tmp_path / "pages.parquet"))
    stats = registry.queries()["crawl_pages_stats"](spark, str(tmp_path)).first().asDict()
    # Two repeated seeds, and the link to a page that was visited.
    assert stats == {
        "pages_visited": 2, "pages_failed": 1, "pages_skipped_robots": 0,
        "duplicate_urls_skipped": 3, "elapsed_seconds": 86400.0,
    }
