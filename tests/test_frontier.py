"""Queue tests, link edges and sources of a traversal."""

from pyspark.sql import functions as F

from pageloom.operators import frontier, robots
from pageloom.schema import FETCH, with_defaults
from pageloom.sources.fetches import fetches_from_pages, read_fetches
from pageloom.sources.robots import read_robots

ROBOTS = "netloc string, http_status int, body string"


def test_reasons_in_order(spark):
    cases = {
        "mailto:a@b": "scheme",
        "ftp://example.com/x": "scheme",
        "https://other.com/seen": "visited",
        "https://other.com/new": "domain",
        "https://notexample.com/": "domain",
        "https://example.com/no/x": "robots",
        "https://Blog.Example.com/no/x": None,
        "https://example.com/yes": None,
        "https://a.b.test:8080/": None,
        "https://a.b.test/": "domain",
    }
    edges = spark.createDataFrame([(u,) for u in cases] * 2, "url string")
    visited = spark.createDataFrame([("https://other.com/seen",)] * 3, "url string")
    roots = spark.createDataFrame([("Example.com",), ("b.test:8080",)], "root string")
    answers = spark.createDataFrame(
        [("example.com", 200, "User-agent: *\nDisallow: /no")], ROBOTS
    )
    policy = robots.robots_policy(answers, "bot")
    rows = frontier.eligible(edges, visited, roots, policy).collect()
    assert len(rows) == 2 * len(cases)
    assert {r["url"]: r["reject_reason"] for r in rows} == cases
    free = frontier.eligible(edges, visited, roots, policy, respect_robots=False)
    assert free.filter("reject_reason = 'robots'").count() == 0
    report = robots.blocked_report(frontier.eligible(edges, visited, roots, policy))
    assert [tuple(r) for r in report.collect()] == [("example.com", 2)]


def test_edges_of_successful_pages_above_the_limit(spark):
    rows = [
        (0, "a", None, 0, ["x", "y"]), (1, "b", "", 0, ["x"]), (2, "c", None, 2, ["x"]), (3, "d", None, 1, []),
    ]
    df = spark.createDataFrame(
        rows, "seq bigint, url string, error string, depth int, internal_links array<string>"
    )
    edges = frontier.link_edges(with_defaults(df, "seq"), max_depth=2).collect()
    assert [(e["src_seq"], e["src_url"], e["src_depth"], e["link_pos"], e["dst_url"]) for e in edges] == [
        (0, "a", 0, 0, "x"), (0, "a", 0, 1, "y"),
    ]


def test_first_occurrence_and_anti_join(spark):
    links = spark.createDataFrame([("x", 2, 0), ("x", 1, 5), ("y", 1, 6)], "url string, s bigint, p int")
    keyed = links.select("url", frontier.link_key(F.col("s"), F.col("p")).alias("key"))
    first = {r["url"]: int(r["key"]) for r in frontier.dedupe_frontier(keyed).collect()}
    assert first == {"x": 2**31 + 5, "y": 2**31 + 6}
    visited = spark.createDataFrame([("x",)], "url string")
    assert [r["url"] for r in frontier.not_visited(keyed, visited).collect()] == ["y"]


def test_stored_inputs(spark, tmp_path):
    rows = [("https://h/", 200, "text/html", "b", "", None)]
    spark.createDataFrame(rows, FETCH).write.parquet(str(tmp_path / "fetches"))
    assert [tuple(r) for r in read_fetches(spark, str(tmp_path / "fetches")).collect()] == rows
    spark.createDataFrame([("H", 200, "x"), ("h", 200, "x")], ROBOTS).write.parquet(str(tmp_path / "robots"))
    assert [tuple(r) for r in read_robots(spark, str(tmp_path / "robots")).collect()] == [("h", 200, "x")]
    pages = spark.createDataFrame([(7, "https://h/", "<p>")], "page_id bigint, url string, html string")
    row = fetches_from_pages(pages).first()
    assert (row["seq"], row["status_code"], row["content_type"], row["body"]) == (7, 200, "text/html", "<p>")


def test_null_root_does_not_let_other_hosts_in(spark):
    from pageloom.operators import frontier

    found = spark.createDataFrame([("https://b.example/x",), ("https://a.example/x",)], "url string")
    roots = spark.createDataFrame([("a.example",), (None,)], "root string")
    none = found.limit(0)
    got = {r.url: r.reject_reason for r in frontier.eligible(found, none, roots).collect()}
    assert got == {"https://b.example/x": "domain", "https://a.example/x": None}
