"""Registered queries over the given tables, each with an equivalent SQL check.

``queries()`` maps names to ``(spark, folder) -> DataFrame``; the SQL over the same
Parquet tables stands in ``oracles.py``. All queries read whole tables.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from functools import partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import oracles
from pageloom.functions import text, urls
from pageloom.operators import fetchlog, frontier, robots, search
from pageloom.operators.pages import page_metrics, parse_pages, record_text
from pageloom.plans.crawl import Crawl, crawl
from pageloom.plans.stages import checkpoint_dir, materialize
from pageloom.sinks import exports
from pageloom.sources import fetches, records as record_io
from pageloom.sources.robots import one_per_host, read_robots
from pageloom.sources.seeds import root_domains, seed_lists

try:
    import corpus_pipeline
    from pageloom.llm import queries as llm_queries
except ModuleNotFoundError as error:  # the folder is optional; anything else is an error
    if error.name not in ("corpus_pipeline", "pageloom.llm"):
        raise
    llm_queries = None

AGENT = "PageBot/1.0 (+https://bot.example/about)"
EVERYTHING = 10**12  # a page budget that no test corpus fills
Query = Callable[[SparkSession, str], DataFrame]


# --- inputs -----------------------------------------------------------------------


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _timestamp(number: Column) -> Column:
    """One day per number, as ISO text."""
    day = F.date_add(F.lit("2026-01-01").cast("date"), number.cast("int"))
    return F.concat(day.cast("string"), F.lit("T00:00:00+00:00"))


def _fetches(pages: DataFrame) -> DataFrame:
    return fetches.fetches_from_pages(pages).withColumn(
        "fetched_at", _timestamp(F.col("seq"))
    )


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    return fetches.spread_small(_table(spark, folder, "pages"), "page_id")


def _captured(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the captured pages."""
    return parse_pages(_fetches(_pages(spark, folder)))


def _enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the pages plus tags they lack, made from each page's own data."""
    number = F.col("page_id").cast("string")
    extra = F.concat(
        F.lit('<meta name=description content="About &amp; '), F.col("url"),
        F.lit("\"><META content='k"), number, F.lit("' NAME=\"keywords\"><h2>Part <b>"),
        number, F.lit('</b></h2><img alt=">" src="img/'), number,
        F.lit('.png"><img src=../logo.png?v=1#x><a href="//cdn.example.org/x/'), number,
        F.lit('">c</a><a href="./next?p=2&amp;q='), number,
        F.lit('#s">n</a><a href="mailto:x@y.example">m</a><a href="#top">t</a>'),
    )
    pages = _pages(spark, folder).withColumn("html", F.concat(extra, F.col("html")))
    return parse_pages(_fetches(pages))


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = fetches.spread_small(_table(spark, folder, "documents"), "doc_id")
    return fetches.records_from_documents(docs)


def _host_answers(spark: SparkSession, folder: str) -> DataFrame:
    """A robots file per host of the pages; its kind follows from the host's length."""
    hosts = _table(spark, folder, "pages").select(
        urls.get_domain(F.col("url")).alias("netloc")
    )
    kind = F.length("netloc") % 7
    rules = (
        "# site rules\nUser-agent: *\nDisallow: /en/\n\n"
        "User-agent: pagebot\nUser-agent: other\nAllow: /fr/8\nDisallow: /fr/\n"
        "Crawl-delay: 5 # slow\n"
    )
    default = "User-agent: Googlebot\nDisallow: /\n\nUser-agent: *\nDisallow: /%65s/\nCrawl-delay: 2\n"
    return one_per_host(
        hosts.withColumns(
            {
                "http_status": F.when(kind == 0, 404)
                .when(kind == 1, 503)
                .when(kind == 2, F.lit(None))
                .when(kind == 3, 401)
                .otherwise(200),
                "body": F.when(kind == 4, default).when(kind > 4, rules),
            }
        )
    )


def _attempts(spark: SparkSession, folder: str) -> DataFrame:
    """Fetch attempts from events: four attempts per URL, outcome by event type."""
    kind = F.col("event_type")
    return _table(spark, folder, "events").select(
        F.concat(F.lit("https://e.example/"), F.floor(F.col("event_id") / 4)).alias("url"),
        (F.col("event_id") % 4 + 1).cast("int").alias("attempt"),
        F.when(kind == "signup", 503).when(kind == "purchase", 404)
        .when(kind == "error", F.lit(None)).otherwise(200).alias("status_code"),
        F.when(kind == "click", "application/pdf")
        .when(kind == "view", "text/html; charset=utf-8").alias("content_type"),
        F.col("props").alias("body"),
        F.lit("").alias("fetched_at"),
        F.when(kind == "error", F.concat(F.lit("timeout "), F.col("event_id"))).alias("error"),
    )


def _responses(spark: SparkSession, folder: str) -> DataFrame:
    """One response per event; half of the errors have an empty text."""
    silent = (F.col("event_type") == "error") & (F.col("value") < 20)
    kind = F.col("event_type")
    return _table(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        F.concat(F.lit("https://h"), F.col("user_id"), F.lit(".example/"), F.col("event_id"))
        .alias("url"),
        F.when(kind == "signup", 503).when(kind == "purchase", 404)
        .when(kind == "error", F.lit(None)).otherwise(200).alias("status_code"),
        F.when(kind == "click", "application/pdf")
        .when(kind.isin("view", "purchase"), "text/html; charset=utf-8").alias("content_type"),
        F.when(silent, "").when(kind == "error", "timeout").alias("error"),
    )


def _tree(spark: SparkSession, folder: str) -> DataFrame:
    """The pages as one site: page i links to its parent and to 8i+1 … 8i+8.

    Whole page texts, their own anchors disabled; pages cut off before their end (but the
    first) answer with status 500. Children beyond the last page were never captured.
    """
    number = F.col("page_id")

    def anchor(target: Column) -> Column:
        return F.concat(F.lit('<a href="/p/'), target.cast("string"), F.lit('">x</a>'))

    links = [anchor(F.greatest(F.floor((number - 1) / 8), F.lit(0)))]
    links += [anchor(8 * number + i) for i in range(1, 9)]
    cut = ~F.col("html").endswith("</html>") & (number > 0)
    return _pages(spark, folder).select(
        F.concat(F.lit("https://tree.example/p/"), number).alias("url"),
        F.when(cut, 500).otherwise(200).alias("status_code"),
        F.lit("text/html").alias("content_type"),
        F.concat(*links, F.replace("html", F.lit("<a href"), F.lit("<a name"))).alias("body"),
        _timestamp(number).alias("fetched_at"),
        F.lit(None).cast("string").alias("error"),
    )


def _tree_crawl(
    spark: SparkSession, folder: str, max_pages: int = EVERYTHING, **options
) -> Crawl:
    root = _table(spark, folder, "pages").agg(F.min("page_id").alias("seq"))
    start = root.select(F.concat(F.lit("https://tree.example/p/"), "seq").alias("url"), "seq")
    return crawl(
        start, _tree(spark, folder), max_depth=64, max_pages=max_pages, **options
    )


def _page_crawl(spark: SparkSession, folder: str) -> Crawl:
    """Every captured page is a seed; one step along the links, under robots rules.

    A URL is visited once, with its first capture; further captures are repeated seeds.
    """
    start = _table(spark, folder, "pages").select("url", F.col("page_id").alias("seq"))
    answers = _host_answers(spark, folder)
    by_url = Window.partitionBy("url").orderBy("page_id", F.xxhash64("html"))
    first = _pages(spark, folder).withColumn("_place", F.row_number().over(by_url))
    return crawl(
        start,
        _fetches(first.filter(F.col("_place") == 1).drop("_place")),
        answers,
        max_depth=1,
        max_pages=EVERYTHING,
        user_agent=AGENT,
    )


def _frontier(spark: SparkSession, folder: str) -> DataFrame:
    """Links of the enriched pages with the reason why each may not be queued."""
    found = _enriched(spark, folder).select(
        "seq", F.posexplode("links").alias("link_pos", "url")
    )
    seen = _table(spark, folder, "pages").select("url")
    roots = root_domains(seen.filter(~F.col("url").contains("spam-farm")))
    policy = robots.robots_policy(_host_answers(spark, folder), AGENT)
    return frontier.eligible(found, seen, roots, policy)


# --- queries ----------------------------------------------------------------------


def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    return _captured(spark, folder).select("seq", "title")


def page_meta(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select("seq", "meta_description", "meta_keywords")


def page_headings(spark: SparkSession, folder: str) -> DataFrame:
    rows = _enriched(spark, folder).select("seq", F.explode("headings").alias("level", "texts"))
    return rows.select(
        "seq",
        "level",
        F.size("texts").cast("bigint").alias("n"),
        F.array_join("texts", "|").alias("texts"),
    )


def page_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return _captured(spark, folder).select(
        "seq",
        F.size("paragraphs").cast("bigint").alias("n"),
        F.array_join("paragraphs", "\n").alias("texts"),
    )


def page_references(spark: SparkSession, folder: str) -> DataFrame:
    """A paragraph of character references, with and without semicolon, before each page."""
    number = F.col("page_id").cast("string")
    extra = F.concat(
        F.lit("<p>&nbsp;&copy "), number, F.lit(" &notit; caf&eacute &hellip;&mdash;&#8364;&#x41;<b> &amp;lt;"),
        number, F.lit("</b>&CounterClockwiseContourIntegral;&unknown; &#xFDD0;&</p>"),
    )
    pages = _pages(spark, folder).withColumn("html", F.concat(extra, F.col("html")))
    records = parse_pages(_fetches(pages))
    return records.select(
        "seq", F.size("paragraphs").cast("bigint").alias("n"), F.array_join("paragraphs", "\n").alias("texts")
    )


def page_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    records = _captured(spark, folder)
    return records.select(
        "seq",
        F.col("word_count").cast("bigint").alias("word_count"),
        F.length(record_text(records)).cast("bigint").alias("n_chars"),
    )


def _wide(metrics: DataFrame) -> DataFrame:
    """Counts as BIGINT, as the SQL side has them."""
    return metrics.select(
        *(
            F.col(name).cast("bigint").alias(name) if kind == "int" else F.col(name)
            for name, kind in metrics.dtypes
        )
    )


def page_flat_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(page_metrics(_enriched(spark, folder)))


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    rows = _enriched(spark, folder).select(
        "seq", "internal_links", F.posexplode("links").alias("pos", "link")
    )
    inside = F.array_contains("internal_links", F.col("link"))
    return rows.select(
        "seq",
        F.col("pos").cast("bigint").alias("pos"),
        "link",
        inside.cast("bigint").alias("internal"),
    )


def link_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select(
        "seq",
        F.size("links").cast("bigint").alias("n_links"),
        F.array_join("internal_links", " ").alias("internal"),
        F.array_join("external_links", " ").alias("external"),
    )


def link_hosts(spark: SparkSession, folder: str) -> DataFrame:
    links = _enriched(spark, folder).select(F.explode("links").alias("link"))
    return links.groupBy(urls.get_domain(F.col("link")).alias("host")).agg(
        F.count("*").alias("n")
    )


def page_images(spark: SparkSession, folder: str) -> DataFrame:
    return _enriched(spark, folder).select("seq", F.array_join("images", " ").alias("images"))


def url_fields(spark: SparkSession, folder: str) -> DataFrame:
    parts = _table(spark, folder, "pages").select(
        "page_id", "url", urls.url_parts(F.col("url")).alias("p")
    )
    url = F.col("url")
    return parts.select(
        "page_id",
        "p.*",
        urls.get_domain(url).alias("domain"),
        urls.is_same_domain(url, F.lit("Example.com")).cast("bigint").alias("in_example_com"),
        urls.is_crawlable_scheme(url).cast("bigint").alias("crawlable"),
    )


def url_resolution(spark: SparkSession, folder: str) -> DataFrame:
    """Five relative references seen from every page URL."""
    references = ["../up", "./same#f", "?q=1", "/root/./x/../y", "#frag"]
    rows = _table(spark, folder, "pages").select(
        "page_id", "url", F.posexplode(F.array(*map(F.lit, references))).alias("n", "ref")
    )
    return rows.select(
        "page_id",
        F.col("n").cast("bigint").alias("n"),
        urls.normalize_url(F.col("url"), F.col("ref")).alias("resolved"),
    )


def keyword_search_pages(spark: SparkSession, folder: str) -> DataFrame:
    return search.keyword_search(_captured(spark, folder), "The", limit=10)


def keyword_search_documents(spark: SparkSession, folder: str) -> DataFrame:
    return search.keyword_search(_documents(spark, folder), "für", limit=25)


def keyword_search_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the benchmark passages, searched in all documents."""
    words = _table(spark, folder, "benchmark").select(
        F.explode(
            F.regexp_extract_all(F.lower("text"), F.lit(f"{text.WORD_CHAR}+"), F.lit(0))
        ).alias("keyword")
    )
    found = search.keyword_search_batch(_documents(spark, folder), words, limit=5, stored=True)
    return found.select("keyword", "rank", "seq", "score", "snippet")


def keyword_search_batch_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of the page titles, searched in all parsed pages."""
    records = materialize(
        _captured(spark, folder).select("seq", "url", "title", "headings", "paragraphs"), "records"
    )
    words = records.select(
        F.explode(
            F.regexp_extract_all(F.lower("title"), F.lit(f"{text.WORD_CHAR}+"), F.lit(0))
        ).alias("keyword")
    )
    found = search.keyword_search_batch(records, words.distinct(), limit=3, stored=True)
    return found.select("keyword", "rank", "seq", "score", "snippet")


def keyword_frequency_pages(spark: SparkSession, folder: str) -> DataFrame:
    return search.keyword_frequency(_captured(spark, folder), top_n=25)


def keyword_frequency_documents(spark: SparkSession, folder: str) -> DataFrame:
    return search.keyword_frequency(_documents(spark, folder), top_n=100)


def document_tokens(spark: SparkSession, folder: str) -> DataFrame:
    tokens = text.tokenize(F.col("text"))
    return _table(spark, folder, "documents").select(
        "doc_id",
        F.size(tokens).cast("bigint").alias("n_tokens"),
        F.array_join(tokens, " ").alias("tokens"),
    )


def frontier_reasons(spark: SparkSession, folder: str) -> DataFrame:
    rows = _frontier(spark, folder)
    return rows.groupBy(F.coalesce("reject_reason", F.lit("queued")).alias("reason")).agg(
        F.count("*").alias("n")
    )


def frontier_next(spark: SparkSession, folder: str) -> DataFrame:
    """First occurrence of every URL that may be queued."""
    queued = _frontier(spark, folder).filter(F.col("reject_reason").isNull())
    key = frontier.link_key(F.col("seq"), F.col("link_pos"))
    first = frontier.dedupe_frontier(queued.select("url", key.alias("key")))
    scale = F.lit(2**31).cast("decimal(10,0)")
    return first.select(
        "url",
        F.floor(F.col("key") / scale).cast("bigint").alias("src_seq"),
        (F.col("key") % scale).cast("bigint").alias("link_pos"),
    )


def blocked_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return robots.blocked_report(_frontier(spark, folder))


def page_link_edges(spark: SparkSession, folder: str) -> DataFrame:
    edges = frontier.link_edges(_enriched(spark, folder), max_depth=2)
    return edges.select("src_seq", F.col("link_pos").cast("bigint").alias("link_pos"), "dst_url")


def _visits(run: Crawl) -> DataFrame:
    return run.records.select(
        "seq",
        "url",
        F.col("depth").cast("bigint").alias("depth"),
        F.coalesce(F.col("status_code").cast("bigint"), F.lit(-1)).alias("status_code"),
        F.coalesce("error", F.lit("")).alias("error"),
        F.col("word_count").cast("bigint").alias("word_count"),
    )


def crawl_tree(spark: SparkSession, folder: str) -> DataFrame:
    return _visits(_tree_crawl(spark, folder))


def crawl_tree_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _tree_crawl(spark, folder).stats


def crawl_budget(spark: SparkSession, folder: str) -> DataFrame:
    return _visits(_tree_crawl(spark, folder, max_pages=40))


def crawl_budget_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _tree_crawl(spark, folder, max_pages=40).stats


def crawl_level(spark: SparkSession, folder: str) -> DataFrame:
    return _visits(_tree_crawl(spark, folder, mode="level"))


def crawl_level_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _tree_crawl(spark, folder, mode="level").stats


def _gaps_crawl(spark: SparkSession, folder: str) -> Crawl:
    """The tree with two attempts per page, and every seventh page never captured.

    The first attempt at a third of the pages timed out; at every fifth page both did.
    """
    number = F.regexp_extract("url", "[0-9]+$", 0).cast("bigint")
    both = _tree(spark, folder).filter(number % 7 != 6).withColumn("status_code", F.lit(200))
    attempts = both.withColumn("attempt", F.explode(F.array(F.lit(1), F.lit(2))))
    lost = ((F.col("attempt") == 1) & (number % 3 == 0)) | ((number % 5 == 4) & (number > 0))
    timed_out = F.concat(F.lit("timeout "), F.col("attempt"))
    attempts = attempts.withColumn("error", F.when(lost, timed_out))
    collapsed = fetchlog.collapse_attempts(attempts, max_retries=2)
    root = _table(spark, folder, "pages").agg(F.min("page_id").alias("seq"))
    start = root.select(F.concat(F.lit("https://tree.example/p/"), "seq").alias("url"), "seq")
    return crawl(start, collapsed, max_depth=64, max_pages=EVERYTHING)


def crawl_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return _visits(_gaps_crawl(spark, folder)).select("seq", "url", "depth", "error")


def crawl_gaps_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _gaps_crawl(spark, folder).stats


def _cut_level_crawl(spark: SparkSession, folder: str) -> Crawl:
    """Batches that the budget cuts: failures leave some of it, so what was cut off comes later.

    Every fourth page of the tree is no HTML.
    """
    number = F.regexp_extract("url", "[0-9]+$", 0).cast("bigint")
    kind = F.when((number % 4 == 3), "application/pdf").otherwise("text/html")
    mixed = _tree(spark, folder).withColumn("content_type", kind)
    root = _table(spark, folder, "pages").agg(F.min("page_id").alias("seq"))
    start = root.select(F.concat(F.lit("https://tree.example/p/"), "seq").alias("url"), "seq")
    return crawl(start, mixed, max_depth=64, max_pages=30, mode="level")


def crawl_level_budget(spark: SparkSession, folder: str) -> DataFrame:
    return _visits(_cut_level_crawl(spark, folder)).select("seq", "url", "depth", "error")


def crawl_level_budget_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _cut_level_crawl(spark, folder).stats.drop("elapsed_seconds")


def crawl_pages(spark: SparkSession, folder: str) -> DataFrame:
    return _visits(_page_crawl(spark, folder)).select("seq", "url", "depth", "error")


def crawl_pages_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _page_crawl(spark, folder).stats


def fetch_collapse(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    rows = fetchlog.collapse_attempts(
        _attempts(spark, folder), max_retries=3, backoff=1.5, strict_status=strict
    )
    return rows.select(
        "url",
        F.col("attempts_used").cast("bigint").alias("attempts_used"),
        F.coalesce(F.col("status_code").cast("bigint"), F.lit(-1)).alias("status_code"),
        F.coalesce("error", F.lit("")).alias("error"),
        "body",
        "planned_wait",
    )


def fetch_classes(spark: SparkSession, folder: str, strict: bool = True) -> DataFrame:
    rows = fetchlog.classify_fetch(_responses(spark, folder), strict_status=strict)
    return rows.select(
        "seq",
        F.coalesce(F.col("status_code").cast("bigint"), F.lit(-1)).alias("status_code"),
        F.coalesce("error", F.lit("(none)")).alias("error"),
    )


def fetch_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return fetchlog.outcome_counts(fetchlog.classify_fetch(_responses(spark, folder)))


def failed_pages(spark: SparkSession, folder: str) -> DataFrame:
    listed, _ = fetchlog.failed_pages(fetchlog.classify_fetch(_responses(spark, folder)))
    return listed


def failed_page_count(spark: SparkSession, folder: str) -> DataFrame:
    _, count = fetchlog.failed_pages(fetchlog.classify_fetch(_responses(spark, folder)))
    return count


def host_delays(spark: SparkSession, folder: str) -> DataFrame:
    policy = robots.robots_policy(_host_answers(spark, folder), AGENT)
    delayed = fetchlog.effective_delay(
        _table(spark, folder, "pages").select("url"), robots.crawl_delay(policy), 1.5
    )
    return fetchlog.host_wait(delayed)


def robots_rule_rows(spark: SparkSession, folder: str) -> DataFrame:
    return robots.robots_rules(_host_answers(spark, folder)).select(
        "netloc",
        "entry_id",
        F.array_join("agents", ",").alias("agents"),
        F.col("is_default").cast("bigint").alias("is_default"),
        F.col("rule_seq").cast("bigint").alias("rule_seq"),
        F.col("allow").cast("bigint").alias("allow"),
        "path_prefix",
        F.coalesce("delay", F.lit(-1)).alias("delay"),
    )


def robots_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    policy = robots.robots_policy(_host_answers(spark, folder), AGENT)
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return robots.robots_allowed(pages, policy).select(
        "page_id", F.col("allowed").cast("bigint").alias("allowed")
    )


def robots_delays(spark: SparkSession, folder: str) -> DataFrame:
    policy = robots.robots_policy(_host_answers(spark, folder), AGENT)
    return robots.crawl_delay(policy).select(
        "netloc", F.coalesce("delay", F.lit(-1.0)).alias("delay")
    )


def sitemap_entries(spark: SparkSession, folder: str) -> DataFrame:
    return exports.sitemap_rows(_captured(spark, folder))


def csv_export_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _wide(exports.csv_rows(_captured(spark, folder)))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/pageloom/{uuid.uuid4().hex}/{name}"


def json_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All records written as JSON Lines and read back."""
    path = _scratch(spark, "lines")
    exports.write_record_lines(_enriched(spark, folder), path)
    return _wide(page_metrics(record_io.read_record_lines(spark, path)))


def document_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All records written as one document in eight parts and read back part by part."""
    path = _scratch(spark, "document")
    exports.write_crawl_json(materialize(_enriched(spark, folder), "records"), path, "run", parts=8)
    return _wide(page_metrics(record_io.read_crawl_json(spark, path)))


def seed_list(spark: SparkSession, folder: str) -> DataFrame:
    """The addresses of each host's pages as one comma-separated text, read as seeds."""
    pages = _table(spark, folder, "pages")
    text = F.concat(F.lit(" , "), F.array_join(F.sort_array(F.collect_set("url")), " ,,\t"), F.lit(", "))
    lists = pages.groupBy(urls.get_domain(F.col("url")).alias("host")).agg(
        text.alias("urls"), F.min("page_id").alias("line")
    )
    return seed_lists(lists).select("url", F.col("depth").cast("bigint").alias("depth"), "seq")


def stored_fetches(spark: SparkSession, folder: str) -> DataFrame:
    """Responses written as a fetch log, read with the log's schema and classified."""
    path = _scratch(spark, "fetches")
    _responses(spark, folder).withColumns(
        {"body": F.lit(None).cast("string"), "fetched_at": _timestamp(F.col("seq") % 1000)}
    ).write.parquet(path)
    rows = fetchlog.classify_fetch(fetches.read_fetches(spark, path))
    return rows.groupBy(F.coalesce("error", F.lit("(none)")).alias("error")).agg(
        F.count("*").alias("n"), F.max("fetched_at").alias("last")
    ).filter("error NOT LIKE '% for url: %'")


def robots_read(spark: SparkSession, folder: str) -> DataFrame:
    """Robots files of hosts in mixed case, each stored twice, once without an answer."""
    path = _scratch(spark, "robots")
    answers = _host_answers(spark, folder)
    lost = answers.withColumns({"http_status": F.lit(None).cast("int"), "body": F.lit(None).cast("string")})
    lost.unionByName(answers.withColumn("netloc", F.upper("netloc"))).write.parquet(path)
    kept = read_robots(spark, path)
    return kept.select(
        "netloc",
        F.coalesce(F.col("http_status").cast("bigint"), F.lit(-1)).alias("http_status"),
        F.coalesce(F.length("body").cast("bigint"), F.lit(-1)).alias("size"),
    )


def sitemap_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All records written as sitemaps; their locations read back."""
    path = _scratch(spark, "sitemap")
    exports.write_sitemap(_captured(spark, folder), path)
    return (
        spark.read.format("xml")
        .option("rowTag", "url")
        .schema("loc string, lastmod string")
        .load(path)
    )


def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark, "csv")
    records = _captured(spark, folder)
    exports.write_csv(records, path)
    plain = page_metrics(records).select(*exports.CSV_COLUMNS)
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(path)

    def value(name: str, kind: str) -> Column:
        """An absent value shows as empty or 0; text that is no number is an error."""
        read = F.col(name)
        if kind == "string":
            return F.coalesce(read, F.lit(""))
        wrong = F.raise_error(F.concat(F.lit(f"{name} is no number: "), read)).cast(kind)
        return F.when(read.isNull(), F.lit(0).cast(kind)).otherwise(F.coalesce(read.try_cast(kind), wrong))

    return _wide(back.select(*(value(n, t).alias(n) for n, t in plain.dtypes)))


def export_all(spark: SparkSession, folder: str) -> DataFrame:
    """A run exported in all formats after an attempt that broke, then once more; read back.

    One row per format: records, their words and links as the format keeps them.
    """
    target = _scratch(spark, "export")
    records = materialize(_enriched(spark, folder), "records")
    # What an export leaves that broke while it wrote: table rows without a commit record.
    broken = exports.table_rows(records, "run").withColumn("attempt", F.lit("0"))
    broken.write.partitionBy("run_id", "attempt").parquet(f"{target}/pages")
    exports.export(records, target, ["csv"], run_id="run")
    exports.export(records, target, run_id="run")
    paths = exports.export(records, target, run_id="run")
    lines = page_metrics(record_io.read_record_lines(spark, paths["json"]))
    table = page_metrics(record_io.read_run(spark, paths["sqlite"], "run"))
    back = spark.read.options(header=True, escape='"', multiLine=True).csv(paths["csv"])
    columns = ["word_count", "num_links", "num_images"]
    kinds = (("json", lines), ("csv", back), ("sqlite", table))
    read = [
        rows.select(F.lit(name).alias("format"), *(F.col(c).cast("bigint").alias(c) for c in columns))
        for name, rows in kinds
    ]
    return read[0].union(read[1]).union(read[2]).groupBy("format").agg(
        F.count("*").alias("n"), *(F.sum(c).alias(c) for c in columns)
    )


def table_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs appended to the page table, one of them repeated; the first read back."""
    path = _scratch(spark, "pages")
    records = materialize(_enriched(spark, folder), "records")
    exports.append_table(records, path, "run-a")
    exports.append_table(records, path, "run-b")
    exports.append_table(records, path, "run-b", replace_run=True)
    back = record_io.read_run(spark, path, "run-a")
    counts = record_io.run_counts(spark, path)
    rows = _wide(page_metrics(back)).select(
        "seq", "url", "word_count", "num_headings", "num_paragraphs", "num_links", "num_images"
    )
    return rows.withColumn("run_id", F.lit("run-b")).join(counts, "run_id")


def entry(spark: SparkSession) -> DataFrame:
    """Keyword frequency over the parsed pages: scan, parse, tokenize, count, top-k."""
    return keyword_frequency_pages(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    plain = [
        page_titles, page_meta, page_headings, page_paragraphs, page_references, page_word_counts,
        page_flat_metrics, page_links, link_classes, link_hosts, page_images,
        url_fields, url_resolution,
        keyword_search_pages, keyword_search_documents, keyword_search_batch,
        keyword_search_batch_pages,
        keyword_frequency_pages, keyword_frequency_documents, document_tokens,
        frontier_reasons, frontier_next, blocked_hosts, page_link_edges,
        crawl_tree, crawl_tree_stats, crawl_budget, crawl_budget_stats,
        crawl_level, crawl_level_stats, crawl_pages, crawl_pages_stats,
        crawl_gaps, crawl_gaps_stats, crawl_level_budget, crawl_level_budget_stats,
        fetch_collapse, fetch_classes, fetch_outcomes, failed_pages, failed_page_count,
        host_delays, robots_rule_rows, robots_verdicts, robots_delays,
        sitemap_entries, csv_export_rows,
        json_round_trip, document_round_trip, sitemap_round_trip, csv_round_trip, table_round_trip,
        export_all, stored_fetches, robots_read, seed_list,
    ]
    registered = {query.__name__: query for query in plain}
    registered["fetch_collapse_lenient"] = partial(fetch_collapse, strict=False)
    registered["fetch_classes_lenient"] = partial(fetch_classes, strict=False)
    if llm_queries:
        registered |= llm_queries.queries()
        registered["pipeline"] = corpus_pipeline.run
    return registered


def oracle_sql() -> dict[str, str]:
    registered = oracles.all_queries()
    if llm_queries:
        registered |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            registered["pipeline"] = corpus_pipeline.ORACLE_SQL
    return registered
