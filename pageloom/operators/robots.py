"""Robots exclusion rules as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.reuse import per_application
from ..functions.text import let, strip
from ..functions.urls import get_domain
from ..plans.stages import materialize, split_join

# --- Fixed values ---------------------------------------------------------------
ANY_AGENT = "*"
_LINE_ENDS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
_DIRECTIVES = ("user-agent", "allow", "disallow", "crawl-delay", "request-rate")
# --------------------------------------------------------------------------------


def unquote(text: Column) -> Column:
    """Percent-decoding as UTF-8; stray ``%`` and ``+`` stay as they are."""
    safe = F.replace(
        F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B")
    )
    return F.when(text.contains("%"), F.url_decode(safe)).otherwise(text)


def _without_bare_marks(path: Column) -> Column:
    """Drop an empty query's ``?`` and an empty fragment's ``#``."""
    no_query = F.regexp_replace(path, r"\A([^?#]*+)\?(?=#|\z)", "$1")
    return F.regexp_replace(no_query, r"\A([^#]*+)#\z", "$1")


def robots_entries(robots: DataFrame) -> DataFrame:
    """Groups of ``(netloc, http_status, body)`` files that were answered.

    ``netloc, entry_id, agents, is_default, rules, delay``; ``rules`` is an array of
    ``(rule_seq, allow, path_prefix)`` in file order. One file is one row, so windows
    and groups by ``netloc`` are bounded by a file's lines and share one shuffle.
    """
    lines = robots.filter(F.col("http_status").between(200, 399)).select(
        "netloc",
        F.posexplode(F.split(F.coalesce("body", F.lit("")), _LINE_ENDS, -1)).alias(
            "line_no", "line"
        ),
    )
    text = strip(F.regexp_extract(F.col("line"), r"\A([^#]*+)", 1))
    pair = lines.select(
        "netloc", "line_no", (F.col("line") == "").alias("blank"), text.alias("text")
    )
    named = F.regexp_extract("text", r"(?s)\A([^:]*+):", 1)
    parsed = pair.select(
        "netloc",
        "line_no",
        F.when(F.col("blank"), "blank").otherwise(F.lower(strip(named))).alias("kind"),
        unquote(strip(F.regexp_extract("text", r"(?s)\A[^:]*+:(.*)", 1))).alias("value"),
    ).filter(F.col("kind").isin("blank", *_DIRECTIVES))

    by_file = Window.partitionBy("netloc").orderBy("line_no")
    is_agent = F.col("kind") == "user-agent"
    # A group opens at an agent line that does not follow another agent line.
    opens = is_agent & (F.coalesce(F.lag("kind").over(by_file), F.lit("")) != "user-agent")
    grouped = parsed.withColumn("opens", opens.cast("int")).withColumn(
        "entry_id", F.sum("opens").over(by_file)
    )
    # An empty line closes it: rules behind it belong to nobody.
    by_group = Window.partitionBy("netloc", "entry_id").orderBy("line_no")
    closed = F.max((F.col("kind") == "blank").cast("int")).over(by_group)
    live = grouped.withColumn("closed", closed).filter(
        (F.col("entry_id") > 0) & (F.col("closed") == 0)
    )
    is_rule = F.col("kind").isin("allow", "disallow")
    delay = F.when(
        (F.col("kind") == "crawl-delay") & F.col("value").rlike(r"\A\p{Nd}+\z"),
        F.col("value").try_cast("bigint"),
    )
    rule = F.struct(
        F.col("line_no").alias("rule_seq"),
        ((F.col("kind") == "allow") | (F.col("value") == "")).alias("allow"),
        _without_bare_marks(F.col("value")).alias("path_prefix"),
    )
    return (
        live.groupBy("netloc", "entry_id")
        .agg(
            F.collect_list(F.when(is_agent, F.col("value"))).alias("agents"),
            F.array_sort(F.collect_list(F.when(is_rule, rule))).alias("rules"),
            F.max_by(delay, F.when(delay.isNotNull(), F.col("line_no"))).alias("delay"),
            F.bool_or(~is_agent).alias("has_rules"),
        )
        .filter("has_rules")
        .select(
            "netloc",
            F.col("entry_id").cast("bigint").alias("entry_id"),
            "agents",
            F.array_contains("agents", ANY_AGENT).alias("is_default"),
            "rules",
            "delay",
        )
    )


def robots_rules(robots: DataFrame) -> DataFrame:
    """One row per rule (one with null rule fields for a group that only has delays)."""
    return robots_entries(robots).select(
        "netloc", "entry_id", "agents", "is_default",
        F.inline_outer("rules"), "delay",
    )


def robots_policy(robots: DataFrame, user_agent: str) -> DataFrame:
    """What each host says to one agent: ``netloc, verdict, rules, delay``.

    ``verdict`` is ``allow`` or ``deny`` for the whole host, or ``rules``. A named group
    beats the default group; of several the first counts. One row per host.
    """
    token = user_agent.split("/")[0].lower()
    named = ~F.col("is_default") & F.exists(
        "agents", lambda a: F.lit(token).contains(F.lower(a))
    )
    rank = F.when(named, F.col("entry_id")).when(
        F.col("is_default"), F.col("entry_id") + F.lit(2**40)
    )
    chosen = (
        robots_entries(robots)
        .withColumn("rank", rank)
        .filter("rank IS NOT NULL")
        .groupBy("netloc")
        .agg(F.min_by(F.struct("rules", "delay"), "rank").alias("entry"))
    )
    status = F.col("http_status")
    verdict = (
        F.when(status.isin(401, 403) | (status >= 500), "deny")
        .when(status.isNull() | (status >= 400) | F.col("entry").isNull(), "allow")
        .otherwise("rules")
    )
    return (
        robots.select("netloc", "http_status")
        .join(chosen, "netloc", "left")
        .select(
            "netloc",
            verdict.alias("verdict"),
            F.col("entry.rules").alias("rules"),
            F.col("entry.delay").alias("delay"),
        )
    )


def _target(url: Column) -> Column:
    """The part of a URL that rules are matched against, percent-decoded."""
    rest = F.regexp_replace(
        F.translate(unquote(url), "\t\r\n", ""),
        r"\A[\x00-\x20]*+(?:[A-Za-z][A-Za-z0-9+.\-]*+:)?+(?://[^/?#]*+)?+",
        "",
    )
    doubled = let(
        rest, lambda r: F.when(r.startswith("//"), F.concat(F.lit("//"), r)).otherwise(r)
    )
    return let(
        _without_bare_marks(doubled), lambda r: F.when(r == "", "/").otherwise(r)
    )


def rule_index(policy: DataFrame) -> DataFrame:
    """The rules of all hosts as a lookup table: ``_domain, _prefix, _first``.

    Of equal prefixes the first rule counts; ``_first`` is twice its number, and one more
    if it allows: a plain number, so that its minimum stays a hash aggregation.
    """
    rules = policy.filter("verdict = 'rules'").select(
        F.col("netloc").alias("_domain"), F.inline("rules")
    )
    return rules.groupBy("_domain", F.col("path_prefix").alias("_prefix")).agg(
        F.min(2 * F.col("rule_seq").cast("bigint") + F.col("allow").cast("bigint")).alias("_first")
    )


def _host_rules(policy: DataFrame) -> DataFrame:
    """``_domain, _verdict, _lengths``: how long the host's prefixes are, each once."""
    lengths = F.array_sort(
        F.array_distinct(F.transform("rules", lambda r: F.length(r["path_prefix"])))
    )
    return policy.select(
        F.col("netloc").alias("_domain"), F.col("verdict").alias("_verdict"), lengths.alias("_lengths")
    )


def robots_judged(urls: DataFrame, policy: DataFrame) -> DataFrame:
    """Adds ``allowed`` to rows of distinct ``url``.

    A URL is cut at the lengths that its host's prefixes have, and the cuts are looked up
    among the rules by an equality join; of those found, the rule with the smallest number
    decides. So the time follows the URLs and the different lengths, not the rules: a host
    with very many rules costs no more than one with few. Hosts' rows are met by a join
    that splits only hosts with very many URLs.
    """
    url = F.col("url")
    placed = urls.withColumns({"_domain": get_domain(url), "_target": _target(url)})
    placed = split_join(placed, _host_rules(policy), "_domain", ["url"])
    cuts = F.filter("_lengths", lambda n: n <= F.length("_target"))
    tested = placed.filter(F.col("_verdict") == "rules").select(
        "url",
        "_domain",
        F.explode(F.transform(cuts, lambda n: F.left(F.col("_target"), n))).alias("_prefix"),
    )
    denied = (
        tested.join(rule_index(policy), ["_domain", "_prefix"])
        .groupBy("url")
        .agg(F.min("_first").alias("_first"))
        .filter("_first % 2 = 0")
        .select("url", F.lit(True).alias("_denied"))
    )
    allowed = ~(F.coalesce("_denied", F.lit(False)) | F.coalesce(F.col("_verdict") == "deny", F.lit(False)))
    return placed.join(denied, "url", "left").select(*urls.columns, allowed.alias("allowed"))


def robots_allowed(
    urls: DataFrame, policy: DataFrame | None, enabled: bool = True
) -> DataFrame:
    """Adds ``allowed`` to rows with a ``url``; the first matching prefix decides.

    Every distinct URL is judged once (:func:`robots_judged`); only the URLs that are
    denied come back to the rows. A null URL is allowed.
    """
    if not enabled or policy is None:
        return urls.withColumn("allowed", F.lit(True))
    targets = urls.filter("url IS NOT NULL").groupBy("url").agg(F.count("*").alias("n"))
    denied = robots_judged(targets, policy).filter("NOT allowed").drop("allowed")
    denied = materialize(denied, "denied")
    hits = denied.select("url", F.lit(False).alias("_allowed"))
    spread = [name for name, kind in urls.dtypes if not kind.startswith("map")]
    return split_join(urls, hits, "url", spread, counts=denied).select(
        *urls.columns, F.coalesce("_allowed", F.lit(True)).alias("allowed")
    )


def crawl_delay(policy: DataFrame, enabled: bool = True) -> DataFrame:
    """``netloc, delay`` in seconds; null where nothing applies."""
    delay = F.col("delay").cast("double") if enabled else F.lit(None).cast("double")
    return policy.select("netloc", delay.alias("delay"))


def blocked_report(rejected: DataFrame) -> DataFrame:
    """Blocked links per host from rows with a ``reject_reason``."""
    return (
        rejected.filter("reject_reason = 'robots'")
        .groupBy(get_domain(F.col("url")).alias("host"))
        .agg(F.count("*").alias("blocked"))
    )
