"""Breadth-first traversal of captured responses under depth, budget and robots rules.

The driver only steers: it loops over levels and holds counts. Pages are parsed once, into
a table in buckets by URL (:class:`~pageloom.plans.graph.PageGraph`); visited URLs lie in
the same buckets. A level moves its own URLs and links, never a page and never what was
visited before, and ends in files, so no lineage grows and visit numbers stay fixed when
executors are lost. Counters are gathered while a level is numbered; no link is read again
for them.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.fetchlog import NOT_CAPTURED_ERROR
from ..operators.frontier import link_key
from ..operators.robots import robots_judged, robots_policy
from ..schema import RECORD_FIELDS, with_defaults
from .graph import PageGraph
from .stages import BucketedTable, materialize, row_index, sorted_rows, split_join

# --- Fixed values ---------------------------------------------------------------
DEFAULT_DEPTH = 2
DEFAULT_PAGES = 100
# --------------------------------------------------------------------------------

# Entries of the queue that are looked at together when little of the budget is left.
_LOOK_AHEAD = 1_000
# Start URLs come before all links in the queue.
_BEFORE_LINKS = "-1000000000000000000000000000000"
_STATS = ("pages_visited", "pages_failed", "pages_skipped_robots", "duplicate_urls_skipped")


@dataclass
class Crawl:
    """Outcome of a traversal: one record per visited URL and one row of counters."""

    records: DataFrame
    stats: DataFrame


def check_arguments(max_depth: int, max_pages: int, mode: str) -> None:
    if max_depth < 0:
        raise ValueError(f"no level to visit: max_depth is {max_depth}")
    if max_pages <= 0:
        raise ValueError(f"no page to visit: max_pages is {max_pages}")
    if mode not in ("fifo", "level"):
        raise ValueError("mode must be 'fifo' or 'level'")


def crawl(
    seeds: DataFrame,
    fetches: DataFrame | PageGraph,
    robots: DataFrame | None = None,
    *,
    max_depth: int = DEFAULT_DEPTH,
    max_pages: int = DEFAULT_PAGES,
    respect_robots: bool = True,
    user_agent: str = "*",
    mode: str = "fifo",
    strict_status: bool | None = None,
) -> Crawl:
    """Visit ``seeds(url, seq)`` and follow internal links through ``fetches``.

    ``fetches`` has one row per URL, or is a :class:`PageGraph` made of them, which several
    traversals can share; URLs without a response become failed records. ``max_pages``
    counts successes only. ``mode="fifo"`` stops at the very success that fills the budget
    and treats HTTP errors as failures; ``mode="level"`` takes whole batches of the queue,
    the newest links first, and accepts any HTML response. ``strict_status`` overrides the
    treatment of HTTP errors (a ``PageGraph`` has its own).
    """
    check_arguments(max_depth, max_pages, mode)
    if seeds.isEmpty():
        raise ValueError("at least one seed URL is required")
    strict = (mode == "fifo") if strict_status is None else strict_status
    policy = None
    if robots is not None and respect_robots:
        policy = materialize(robots_policy(robots, user_agent), "robots")
    graph = fetches if isinstance(fetches, PageGraph) else PageGraph(fetches, strict)
    walk = _Fifo if mode == "fifo" else _Level
    return walk(graph, policy, max_depth, max_pages).run(seeds)


def _seed_entries(seeds: DataFrame) -> DataFrame:
    key = F.lit(_BEFORE_LINKS).cast("decimal(38,0)") + F.col("seq").cast("decimal(19,0)")
    return seeds.select(
        "url",
        key.cast("decimal(38,0)").alias("key"),
        F.lit(None).cast("bigint").alias("src_seq"),
        F.lit(0).alias("depth"),
    )


def _micros() -> Column:
    return F.unix_micros(F.try_to_timestamp(F.col("fetched_at")))


@dataclass
class _Counts:
    """Running counters; the driver holds nothing else of the visited pages."""

    succeeded: int = 0
    failed: int = 0
    blocked: int = 0
    repeated: int = 0
    first: int | None = None  # capture times in microseconds
    last: int | None = None

    def add(self, **more: int | None) -> None:
        """Add what is given; other names are ignored."""
        for name in ("succeeded", "failed", "blocked", "repeated"):
            setattr(self, name, getattr(self, name) + (more.get(name) or 0))
        times = [t for t in (self.first, self.last, more.get("first"), more.get("last")) if t is not None]
        if times:
            self.first, self.last = min(times), max(times)

    def row(self, spark: SparkSession) -> DataFrame:
        counted = (self.succeeded, self.failed, self.blocked, self.repeated)
        elapsed = round((self.last - self.first) / 1e6, 2) if self.first is not None else 0.0
        return spark.range(1).select(
            *(F.lit(n).cast("bigint").alias(name) for n, name in zip(counted, _STATS)),
            F.lit(elapsed).alias("elapsed_seconds"),
        )


@dataclass
class _Walk:
    graph: PageGraph
    policy: DataFrame | None
    max_depth: int
    max_pages: int
    counts: _Counts = field(default_factory=_Counts)
    size: int = 0  # visited URLs

    def run(self, seeds: DataFrame) -> Crawl:
        spark = seeds.sparkSession
        self.visited = BucketedTable(spark, "visited", "url", self.graph.buckets)
        self.visited.append(
            _seed_entries(seeds).limit(0).select("url", F.lit(0).cast("bigint").alias("seq"), "depth")
        )
        self.walk(_seed_entries(seeds))
        return Crawl(self._records(), self.counts.row(spark))

    def _records(self) -> DataFrame:
        """Visited URLs meet their pages in the buckets; what was not captured is a failure."""
        pages = self.graph.records().withColumn("_captured", F.lit(True))
        found = self.visited.rows().join(pages, "url", "left")
        missed = F.col("_captured").isNull()
        error = F.when(missed, NOT_CAPTURED_ERROR).otherwise(F.col("error"))
        return with_defaults(found.withColumn("error", error), "seq")

    def _seen(self) -> DataFrame:
        return self.visited.rows().select("url", F.lit(True).alias("seen"))

    def _judged(self, targets: DataFrame) -> DataFrame:
        """Distinct URLs with ``seen`` and ``allowed``, and the state of their pages.

        The buckets of visited URLs and of pages stay where they are.
        """
        known = targets.join(self._seen(), "url", "left")
        known = known.join(self.graph.states(), "url", "left")
        if self.policy is None:
            return known.withColumn("allowed", F.lit(True))
        return robots_judged(known, self.policy)

    def _visit(self, rows: DataFrame) -> int:
        """Store a level's ``(url, seq, depth)``; returns its number."""
        return self.visited.append(rows.select("url", F.col("seq").cast("bigint").alias("seq"), "depth"))

    def _links(self, part: int) -> DataFrame:
        """Queue entries ``(url, key, src_seq, depth)`` that a level's pages open.

        Both sides lie in the same buckets. Pages at the greatest depth open nothing.
        """
        level = self.visited.rows(part).filter(F.col("depth") < self.max_depth)
        return (
            level.join(self.graph.links(), "url")
            .select("seq", "depth", F.posexplode("internal_links").alias("link_pos", "target"))
            .select(
                F.col("target").alias("url"),
                link_key(F.col("seq"), F.col("link_pos")).alias("key"),
                F.col("seq").alias("src_seq"),
                (F.col("depth") + 1).alias("depth"),
            )
        )

    def _found(self, saved: DataFrame, part: Column) -> list:
        """Counters of a sorted level, one row for each of its parts."""
        fresh = F.col("reason").isNull()
        return (
            saved.groupBy(part.alias("part"))
            .agg(
                F.count_if(fresh).alias("fresh"),
                F.count_if(fresh & _ok()).alias("succeeded"),
                F.count_if(fresh & ~_ok()).alias("failed"),
                # Of all entries for a new URL one leads to it.
                F.sum(F.when(fresh, F.col("n") - 1).when(F.col("reason") == "visited", F.col("n")))
                .alias("repeated"),
                F.sum(F.when(F.col("reason") == "robots", F.col("n"))).alias("blocked"),
                F.min(F.when(fresh, _micros())).alias("first"),
                F.max(F.when(fresh, _micros())).alias("last"),
            )
            .collect()
        )

    def _count(self, found: list) -> None:
        for row in found:
            self.counts.add(**row.asDict())


def _reason() -> Column:
    return F.when(F.col("seen"), "visited").when(~F.col("allowed"), "robots")


def _ok() -> Column:
    return F.coalesce("ok", F.lit(False))


def _page_counts() -> list[Column]:
    """Counters of rows that are visited."""
    return [
        F.count_if(_ok()).alias("succeeded"),
        F.count_if(~_ok()).alias("failed"),
        F.min(_micros()).alias("first"),
        F.max(_micros()).alias("last"),
    ]


# --- fifo -----------------------------------------------------------------------


class _Fifo(_Walk):
    """Levels in the order of their pages' links, until the budget is filled."""

    def walk(self, entries: DataFrame) -> None:
        for depth in range(self.max_depth + 1):
            # One row per URL, with all links to it; partial minima in every task.
            targets = entries.groupBy("url").agg(F.min("key").alias("key"), F.count("*").alias("n"))
            judged = self._judged(targets).withColumn("reason", _reason())
            # Rejected URLs are written along, behind the level, to be counted once.
            rows = judged.select("url", "key", "n", "ok", "fetched_at", "reason")
            saved, part = sorted_rows(rows, F.col("reason").isNotNull(), "key")
            found = self._found(saved, part)
            index, size = row_index({r["part"]: r["fresh"] for r in found})
            level = saved.filter("reason IS NULL").withColumn("seq", index + self.size)
            if sum(r["succeeded"] for r in found) >= self.max_pages - self.counts.succeeded:
                self._fill(saved, level, found, entries, depth)
                return
            self._count(found)
            if size == 0:
                return
            number = self._visit(level.withColumn("depth", F.lit(depth)))
            self.size += size
            if depth < self.max_depth:
                entries = self._links(number)

    def _fill(
        self, saved: DataFrame, level: DataFrame, found: list, entries: DataFrame, depth: int
    ) -> None:
        """The level in which the budget is filled, up to that very success.

        Entries of the queue behind it were never taken: a link among them was only tested
        when it was queued, against what had been visited by then and against the robots
        rules. The same holds for all links that this level's pages opened.
        """
        left = self.max_pages - self.counts.succeeded
        for part in sorted(found, key=lambda r: r["part"]):
            if part["succeeded"] >= left:
                break
            left -= part["succeeded"]
        # Only the part that holds the success is ranked.
        inside = level.filter((F.shiftright("_id", 33) == part["part"]) & _ok())
        firsts = inside.orderBy("_id").limit(left)
        last = firsts.agg(F.max("seq").alias("seq"), F.max("key").alias("key")).first()
        kept = level.filter(F.col("seq") <= last["seq"])
        self.counts.add(**kept.agg(*_page_counts()).first().asDict())
        number = self._visit(kept.withColumn("depth", F.lit(depth)))
        first_seq, self.size = self.size, last["seq"] + 1

        taken = F.col("key") <= F.lit(last["key"]).cast("decimal(38,0)")
        visits = self.visited.rows().select("url", F.col("seq").alias("visit_seq"))
        # Taken entries of a visited URL are repetitions, but for the one that led to it.
        own = F.when(F.col("visit_seq") >= first_seq, 1).otherwise(0)
        repeated = (
            entries.groupBy("url").agg(F.count_if(taken).alias("n"))
            .join(visits, "url")
            .agg(F.sum(F.col("n") - own).alias("n"))
            .first()["n"]
        )
        # Links that were queued, or not, but never taken.
        waiting = entries.filter(~taken & F.col("src_seq").isNotNull())
        if depth < self.max_depth:
            waiting = waiting.unionByName(self._links(number))
        waiting = materialize(waiting.select("url", "key", "src_seq"), "waiting")
        met = split_join(waiting, visits, "url", ["key"], "inner")
        early = met.agg(F.count_if(F.col("visit_seq") <= F.col("src_seq")).alias("n")).first()["n"]

        denied = saved.filter("reason = 'robots'")
        if depth == 0:  # start URLs meet the rules when they are taken
            denied = entries.filter(taken).join(denied.select("url"), "url", "left_semi")
            denied = denied.withColumn("n", F.lit(1))
        blocked = denied.agg(F.sum("n").alias("n")).first()["n"] or 0
        if depth < self.max_depth and self.policy is not None:
            targets = self._links(number).groupBy("url").agg(F.count("*").alias("n"))
            tested = robots_judged(targets, self.policy).filter("NOT allowed")
            blocked += tested.agg(F.sum("n").alias("n")).first()["n"] or 0
        self.counts.add(repeated=(repeated or 0) + early, blocked=blocked)


# --- level ----------------------------------------------------------------------


@dataclass
class _Segment:
    """Entries that one round has put into the queue, in order; read from ``start``."""

    rows: DataFrame
    start: int
    size: int


class _Level(_Walk):
    """Batches from the head of the queue, at most as many entries as pages are open.

    New links go in front of what a batch left over. A batch without a page to fetch ends
    the run, whatever is left. The queue is a list of segments, the newest first: each is
    written once, in order, and read by ranges of its row numbers, so a round never writes
    again what others have left.
    """

    def walk(self, entries: DataFrame) -> None:
        queue = [self._segment(entries)]
        while True:
            queue = [s for s in queue if s.start < s.size]
            open_pages = self.max_pages - self.counts.succeeded
            if not queue or open_pages <= 0:
                return
            waiting = sum(s.size - s.start for s in queue)
            taken, ends = min(open_pages, waiting), False
            if open_pages < min(waiting, _LOOK_AHEAD):
                taken, ends = self._batches(queue, open_pages, waiting)
            judged = self._judged(self._firsts(self._head(queue, taken)))
            judged = judged.withColumn("reason", _reason())
            rows = judged.select("url", "place", "depth", "n", "ok", "fetched_at", "reason")
            saved, part = sorted_rows(rows, F.col("reason").isNotNull(), "place")
            found = self._found(saved, part)
            self._count(found)
            index, fresh = row_index({r["part"]: r["fresh"] for r in found})
            if fresh:
                level = saved.filter("reason IS NULL").withColumn("seq", index + self.size)
                number = self._visit(level)
                self.size += fresh
            if ends or not fresh:
                return
            for segment in queue:
                step = min(segment.size - segment.start, taken)
                segment.start += step
                taken -= step
            queue.insert(0, self._opened(number))

    def _firsts(self, batch: DataFrame) -> DataFrame:
        return batch.groupBy("url").agg(
            F.min("place").alias("place"),
            F.min_by("depth", "place").alias("depth"),
            F.count("*").alias("n"),
        )

    def _batches(self, queue: list[_Segment], size: int, waiting: int) -> tuple[int, bool]:
        """How many entries to take when little of the budget is left.

        A batch of nothing but failures opens no links and leaves the budget as it is, so
        the next one follows in the queue. All batches up to the first with a success, or
        the first without a page to fetch, which ends the run, are taken together.
        """
        most = min(waiting, -(-_LOOK_AHEAD // size) * size)
        judged = self._judged(self._firsts(self._head(queue, most)))
        batch = F.floor(F.col("place") / size)
        state = judged.filter(_reason().isNull()).agg(
            F.min(F.when(_ok(), batch)).alias("good"), F.collect_set(batch).alias("filled")
        ).first()
        last = -(-most // size) - 1
        empty = next((i for i in range(last + 1) if i not in set(state["filled"])), None)
        stops = [i for i in (state["good"], empty) if i is not None]
        last = min([last, *stops])
        return min(most, (last + 1) * size), last == empty

    def _segment(self, entries: DataFrame) -> _Segment:
        saved, part = sorted_rows(entries.select("url", "key", "depth"), "key")
        sizes = saved.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
        index, size = row_index({r["part"]: r["n"] for r in sizes})
        return _Segment(saved.withColumn("row", index), 0, size)

    def _head(self, queue: list[_Segment], most: int) -> DataFrame:
        """The first ``most`` entries, with their ``place``."""
        parts, taken = [], 0
        for segment in queue:
            n = min(segment.size - segment.start, most - taken)
            if n == 0:
                break
            rows = segment.rows.filter(F.col("row").between(segment.start, segment.start + n - 1))
            place = F.col("row") - segment.start + taken
            parts.append(rows.select("url", "depth", place.alias("place")))
            taken += n
        return reduce(DataFrame.unionByName, parts)

    def _opened(self, number: int) -> _Segment:
        """Links of a batch's pages that may be queued; the others are counted."""
        links = self._links(number).select("url", "key", "depth")
        targets = links.groupBy("url").agg(F.count("*").alias("n"))
        judged = targets.join(self._seen(), "url", "left")
        if self.policy is None:
            judged = judged.withColumn("allowed", F.lit(True))
        else:
            judged = robots_judged(judged, self.policy)
        rejected = judged.withColumn("reason", _reason()).filter("reason IS NOT NULL")
        rejected = materialize(rejected.select("url", "n", "reason"), "rejected")
        found = rejected.groupBy("reason").agg(F.sum("n").alias("n")).collect()
        sums = {r["reason"]: r["n"] for r in found}
        self.counts.add(repeated=sums.get("visited"), blocked=sums.get("robots"))
        joined = split_join(
            links, rejected.select("url", "reason"), "url", ["key"], counts=rejected.select("url", "n")
        )
        return self._segment(joined.filter("reason IS NULL"))
