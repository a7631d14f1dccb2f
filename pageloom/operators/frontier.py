"""Steps of a breadth-first traversal over page records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.urls import domain_suffixes, get_domain, is_crawlable_scheme
from ..plans.stages import materialize, split_join
from .robots import robots_judged

_LINKS_PER_PAGE = 2**31  # an array cannot hold more


def link_key(parent_seq: Column, link_pos: Column) -> Column:
    """Queue order of a link as one number: visit order of its page, then position.

    Fixed-width, so ``min`` over it stays a hash aggregation.
    """
    scale = F.lit(_LINKS_PER_PAGE).cast("decimal(10,0)")
    return (
        parent_seq.cast("decimal(19,0)") * scale + link_pos.cast("decimal(10,0)")
    ).cast("decimal(38,0)")


def link_edges(records: DataFrame, max_depth: int) -> DataFrame:
    """One row per internal link of a successful page above the depth limit.

    ``src_seq, src_url, src_depth, link_pos, dst_url``.
    """
    return records.filter(
        F.col("error").isNull() & (F.col("depth") < max_depth)
    ).select(
        F.col("seq").alias("src_seq"),
        F.col("url").alias("src_url"),
        F.col("depth").alias("src_depth"),
        F.posexplode("internal_links").alias("link_pos", "dst_url"),
    )


def dedupe_frontier(candidates: DataFrame) -> DataFrame:
    """First occurrence per URL of ``(url, key, …)``; partial minima in every task."""
    return candidates.groupBy("url").agg(F.min("key").alias("key"))


def not_visited(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Anti join on the exact URL."""
    return candidates.join(visited.select("url"), "url", "left_anti")


def _inside(domains: DataFrame, roots: DataFrame) -> DataFrame:
    """Adds ``_inside`` to distinct ``_domain`` rows: equal to a root or below one.

    The suffix test is an equality join: hosts, exploded to all their suffixes, are looked
    up among the roots. NULL roots (seeds without a URL) match nothing.
    """
    suffixes = domains.select(
        "_domain", F.explode(domain_suffixes(F.col("_domain"))).alias("root")
    )
    named = roots.select(F.lower("root").alias("root")).dropna()
    hits = suffixes.join(named, "root", "left_semi").select("_domain").distinct()
    hits = hits.withColumn("_hit", F.lit(True))
    return domains.join(hits, "_domain", "left").select(
        *domains.columns, F.col("_hit").isNotNull().alias("_inside")
    )


def eligible(
    edges: DataFrame,
    visited: DataFrame,
    roots: DataFrame,
    policy: DataFrame | None = None,
    respect_robots: bool = True,
) -> DataFrame:
    """Adds ``reject_reason`` to rows with a ``url``; null means the URL may be queued.

    Tests in this order: ``scheme``, ``visited`` (a duplicate), ``domain``, ``robots``.

    Each distinct URL is judged once: a partial count in every task leaves one row of a URL
    that very many links name, and the counts tell which URLs and hosts must be split when
    the verdicts are joined back.
    """
    edges = materialize(edges, "edges")
    url = F.col("url")
    targets = edges.groupBy("url").agg(F.count("*").alias("n"))
    targets = materialize(targets.withColumn("_domain", get_domain(url)), "targets")
    domains = targets.groupBy("_domain").agg(F.count("*").alias("n"))
    domains = materialize(_inside(domains, roots), "domains")
    judged = split_join(
        targets, domains.drop("n"), "_domain", ["url"], counts=domains.select("_domain", "n")
    )
    seen = visited.select("url").distinct().withColumn("_seen", F.lit(True))
    judged = judged.join(seen, "url", "left")
    if policy is not None and respect_robots:
        judged = robots_judged(judged, policy)
    else:
        judged = judged.withColumn("allowed", F.lit(True))
    reason = (
        F.when(~is_crawlable_scheme(url), "scheme")
        .when(F.col("_seen"), "visited")
        .when(~F.coalesce("_inside", F.lit(False)), "domain")
        .when(~F.col("allowed"), "robots")
    )
    judged = materialize(judged.select("url", "n", reason.alias("reject_reason")), "judged")
    # Links to one hot URL differ in where they come from.
    spread = [name for name, kind in edges.dtypes if not kind.startswith("map")]
    rejected = judged.filter("reject_reason IS NOT NULL")
    joined = split_join(
        edges, rejected.drop("n"), "url", spread, counts=rejected.select("url", "n")
    )
    lost = F.when(url.isNull(), "domain")  # a null URL is in no domain
    return joined.select(*edges.columns, F.coalesce("reject_reason", lost).alias("reject_reason"))
