"""Traversal against a queue simulation on random graphs."""

import random
from dataclasses import dataclass, field

import pytest
from pyspark.sql import functions as F

from pageloom.plans import crawl as plan, stages
from pageloom.plans.crawl import crawl
from pageloom.plans.graph import PageGraph
from pageloom.schema import FETCH
from pageloom.sources.fetches import save_fetches
from pageloom.sources.seeds import root_domains, seeds

SITE = "https://site.example/n"
ROBOTS = "netloc string, http_status int, body string"


@dataclass
class Graph:
    links: dict
    failing: set
    denied: set
    starts: list
    absent: set = field(default_factory=set)


def random_graph(seed: int) -> Graph:
    rng = random.Random(seed)
    size = rng.randint(8, 30)
    nodes = range(size)
    links = {n: [rng.choice(nodes) for _ in range(rng.randint(0, 5))] for n in nodes}
    links = {n: list(dict.fromkeys(targets)) for n, targets in links.items()}
    draw = lambda share: {n for n in nodes if rng.random() < share}
    starts = [rng.choice(nodes) for _ in range(rng.randint(1, 4))]
    return Graph(links, draw(0.2), draw(0.15), starts, draw(0.05))


class Simulation:
    """Visits one node at a time, or a batch at a time, and counts what it skips."""

    def __init__(self, graph, max_depth, max_pages):
        self.graph, self.max_depth, self.max_pages = graph, max_depth, max_pages
        self.seen, self.order = set(), []
        self.ok = self.bad = self.blocked = self.repeated = 0

    def admit(self, node):
        if node in self.seen:
            self.repeated += 1
        elif node in self.graph.denied:
            self.blocked += 1
        else:
            return True
        return False

    def visit(self, node, depth):
        failed = node in self.graph.failing or node in self.graph.absent
        self.order.append((node, depth, failed))
        self.ok, self.bad = self.ok + (not failed), self.bad + failed
        return not failed and depth < self.max_depth

    def opened(self, node, depth):
        return [(n, depth + 1) for n in self.graph.links[node] if self.admit(n)]

    def fifo(self):
        waiting = [(n, 0) for n in self.graph.starts]
        while waiting and self.ok < self.max_pages:
            node, depth = waiting.pop(0)
            if self.admit(node):
                self.seen.add(node)
                if self.visit(node, depth):
                    waiting += self.opened(node, depth)
        return self

    def level(self):
        waiting = [(n, 0) for n in self.graph.starts]
        while waiting and self.ok < self.max_pages:
            room = self.max_pages - self.ok
            head, tail = waiting[:room], waiting[room:]
            batch = []
            for node, depth in head:
                if self.admit(node):
                    self.seen.add(node)
                    batch.append((node, depth))
            if not batch:
                break
            expanding = [entry for entry in batch if self.visit(*entry)]
            waiting = [e for entry in expanding for e in self.opened(*entry)] + tail
        return self


def _tables(spark, graph):
    rows = []
    for node, targets in graph.links.items():
        if node in graph.absent:
            continue
        body = "".join(f'<a href="/n{t}">x</a>' for t in targets)
        kind = "text/plain" if node in graph.failing else "text/html"
        rows.append((f"{SITE}{node}", 200, kind, body, "", None))
    return spark.createDataFrame(rows, FETCH)


def _run(spark, graph, mode, max_depth, max_pages):
    fetches = _tables(spark, graph)
    body = "User-agent: *\n" + "".join(f"Disallow: /n{n}\n" for n in sorted(graph.denied))
    robots = spark.createDataFrame([("site.example", 200, body)], ROBOTS)
    run = crawl(
        seeds(spark, [f"{SITE}{n}" for n in graph.starts]),
        fetches,
        robots,
        max_depth=max_depth,
        max_pages=max_pages,
        mode=mode,
    )
    rows = run.records.select("seq", "url", "depth", "error").orderBy("seq").collect()
    assert [r["seq"] for r in rows] == list(range(len(rows)))
    order = [(int(r["url"].removeprefix(SITE)), r["depth"], r["error"] is not None) for r in rows]
    return order, run.stats.first()


@pytest.mark.parametrize("mode", ["fifo", "level"])
@pytest.mark.parametrize(
    "seed, max_depth, max_pages",
    [(1, 2, 100), (2, 6, 7), (3, 6, 3), (4, 0, 2), (5, 4, 1), (6, 6, 10)],
)
def test_random_graphs(spark, monkeypatch, mode, seed, max_depth, max_pages):
    if seed == 2:  # nothing is broadcast and a key of three rows is hot
        monkeypatch.setattr(stages, "BROADCAST_ROWS", 0)
        monkeypatch.setattr(stages, "HOT_ROWS", 2)
    graph = random_graph(seed)
    shift = 100  # three digits each: no node is a prefix of another
    graph = Graph(
        {n + shift: [t + shift for t in ts] for n, ts in graph.links.items()},
        *({n + shift for n in part} for part in (graph.failing, graph.denied)),
        [n + shift for n in graph.starts],
        {n + shift for n in graph.absent},
    )
    want = getattr(Simulation(graph, max_depth, max_pages), mode)()
    order, stats = _run(spark, graph, mode, max_depth, max_pages)
    assert order == want.order
    assert (
        stats["pages_visited"],
        stats["pages_failed"],
        stats["pages_skipped_robots"],
        stats["duplicate_urls_skipped"],
    ) == (want.ok, want.bad, want.blocked, want.repeated)


def test_arguments(spark):
    fetches = spark.createDataFrame([], FETCH)
    start = seeds(spark, ["https://h/"])
    for bad in ({"max_depth": -1}, {"max_pages": 0}, {"mode": "x"}):
        with pytest.raises(ValueError):
            crawl(start, fetches, **bad)
    with pytest.raises(ValueError, match="seed"):
        crawl(seeds(spark, []), fetches)


def test_only_denied_seeds(spark):
    robots = spark.createDataFrame([("h", 401, "")], ROBOTS)
    for mode in ("fifo", "level"):
        run = crawl(seeds(spark, ["https://h/"]), spark.createDataFrame([], FETCH), robots, mode=mode)
        assert run.records.count() == 0
        assert tuple(run.stats.first())[:4] == (0, 0, 1, 0)


def test_duplicate_responses_are_refused(spark):
    rows = [("https://h/", 200, "text/html", "", "", None)] * 2
    with pytest.raises(ValueError, match="collapse_attempts"):
        crawl(seeds(spark, ["https://h/"]), spark.createDataFrame(rows, FETCH))


def test_status_and_time(spark):
    rows = [
        ("https://h/", 200, "text/html", '<a href="/e">', "2026-01-01T00:00:00.500000+00:00", None),
        ("https://h/e", 404, "text/html", "<title>gone</title>", "2026-01-01T00:00:02.250000+00:00", None),
    ]
    fetches = spark.createDataFrame(rows, FETCH)
    strict = crawl(seeds(spark, "https://h/"), fetches)
    errors = [r["error"] for r in strict.records.orderBy("seq").collect()]
    assert errors == [None, "404 Client Error: Not Found for url: https://h/e"]
    assert strict.stats.first()["elapsed_seconds"] == 1.75
    lenient = crawl(seeds(spark, "https://h/"), fetches, mode="level").records.orderBy("seq").collect()
    assert [(r["status_code"], r["title"]) for r in lenient] == [(200, ""), (404, "gone")]


def test_seeds(spark):
    got = seeds(spark, " https://A.example , ,https://a.example/,").orderBy("seq").collect()
    assert [tuple(r) for r in got] == [("https://A.example", 0, 0), ("https://a.example/", 0, 1)]
    assert [r["root"] for r in root_domains(seeds(spark, [g["url"] for g in got])).collect()] == ["a.example"]


def test_level_moves_no_page_and_nothing_visited(spark, monkeypatch):
    """Buckets of pages and of visited URLs are joined without an exchange above them."""
    monkeypatch.setattr(stages, "BROADCAST_ROWS", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        graph = PageGraph(_tables(spark, random_graph(2)))
        walk = plan._Fifo(graph, None, 3, 100)
        walk.visited = stages.BucketedTable(spark, "visited", "url", graph.buckets)
        first = spark.createDataFrame([(f"{SITE}1", 0, 0), (f"{SITE}2", 1, 0)], "url string, seq long, depth int")
        walk._visit(first)
        walk._visit(spark.createDataFrame([(f"{SITE}3", 2, 1)], first.schema))
        targets = walk._links(1).groupBy("url").agg(F.min("key").alias("key"), F.count("*").alias("n"))
        judged = walk._judged(targets)._jdf.queryExecution().executedPlan().toString()
        assert judged.count("Exchange") == 1 and judged.count("SortMergeJoin") == 3
        assert "paragraphs" not in judged and "body" not in judged
        records = walk._records()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in records
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_graph_for_many_runs(spark):
    fetches = _tables(spark, random_graph(3))
    graph = PageGraph(fetches, buckets=3)
    start = seeds(spark, [f"{SITE}{n}" for n in random_graph(3).starts])
    for depth in (0, 3):
        shared = crawl(start, graph, max_depth=depth).records.orderBy("seq").collect()
        assert shared == crawl(start, fetches, max_depth=depth).records.orderBy("seq").collect()


def test_bucketed_responses_do_not_move(spark):
    rows = [(f"https://h/{i}", 200, "text/html", "", "", None) for i in range(20)]
    name = f"fetches_{random.randrange(10**9)}"
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = save_fetches(spark.createDataFrame(rows, FETCH), name, 4)
        batch = spark.createDataFrame([("https://h/3",)], "url string")
        physical = batch.join(stored, "url")._jdf.queryExecution().executedPlan().toString()
        assert physical.count("Exchange") == 1  # the batch only
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_duplicate_capture_is_an_error_even_with_a_miss(spark):
    import pytest

    from pageloom.plans.crawl import crawl

    url = "https://site.example/"
    start = spark.createDataFrame([(url + "a", 0), (url + "b", 1)], "url string, seq long")
    row = (url + "a", 200, "text/html", "<p>x</p>", "", None)
    fetches = spark.createDataFrame(
        [row, row],
        "url string, status_code int, content_type string, body string, fetched_at string, error string",
    )
    with pytest.raises(ValueError, match="several responses"):
        crawl(start, fetches, max_depth=1, max_pages=5).records.collect()
