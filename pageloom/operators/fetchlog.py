"""Operators on the log of fetch attempts and responses."""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.reuse import per_application
from ..functions.urls import get_domain
from ..plans.stages import split_join

# --- Fixed values ---------------------------------------------------------------
HTML_CONTENT_TYPE = "text/html"
NON_HTML_ERROR = "Non-HTML content-type: "
NOT_CAPTURED_ERROR = "not captured"
DEFAULT_RETRIES = 3
DEFAULT_BACKOFF = 1.5
# --------------------------------------------------------------------------------


def _http_failure() -> Column:
    """A status that counts as a failed request in strict mode."""
    return F.coalesce(F.col("status_code").between(400, 599), F.lit(False))


def _http_error() -> Column:
    """``404 Client Error: Not Found for url: …``, with the standard reason phrases."""
    pairs = [
        F.lit(x)
        for status in HTTPStatus
        if status >= 400
        for x in (int(status), status.phrase)
    ]
    status = F.col("status_code").cast("int")
    side = F.when(status < 500, "Client").otherwise("Server")
    reason = F.coalesce(F.try_element_at(F.create_map(*pairs), status), F.lit(""))
    return F.concat(
        status.cast("string"), F.lit(" "), side, F.lit(" Error: "), reason,
        F.lit(" for url: "), F.col("url"),
    )


def collapse_attempts(
    attempts: DataFrame,
    max_retries: int = DEFAULT_RETRIES,
    backoff: float = DEFAULT_BACKOFF,
    strict_status: bool = True,
) -> DataFrame:
    """One row per URL from ``(url, attempt, status_code, content_type, body, error…)``.

    The first success among attempts 1..``max_retries`` wins, else the last failure.
    Adds ``attempts_used`` and ``planned_wait``: ``backoff ** i`` seconds after each
    used attempt ``i`` but the last. In strict mode a 4xx/5xx status is a failure.

    One pass and one exchange: each task ranks its own rows of a URL and sends only the
    best one, so a URL with very many rows is reduced before the shuffle, and no body lies in
    an aggregation buffer. Of several rows of the winning attempt the one with the least hash
    of its fields stays (fields of map type are not hashed).
    """
    failed = F.col("error").isNotNull()
    if strict_status:
        failed = failed | _http_failure()
    # Successes rank by attempt; failures come behind all of them, the last one first.
    rank = F.when(failed, 2 * F.lit(max_retries) - F.col("attempt")).otherwise(
        F.col("attempt") - max_retries
    )
    fields = [c for c in attempts.columns if c not in ("url", "attempt")]
    hashed = [c for c, kind in attempts.dtypes if c in fields and "map<" not in kind]
    best = Window.partitionBy("url").orderBy(rank, F.xxhash64(F.lit(0), *hashed))
    chosen = (
        attempts.filter(F.col("attempt").between(1, max_retries))
        .withColumn("_place", F.row_number().over(best))
        .filter(F.col("_place") == 1)
        .select("url", F.col("attempt").alias("attempts_used"), *fields)
    )
    waits = F.when(
        F.col("attempts_used") > 1,
        F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.col("attempts_used") - 1, F.lit(1))),
            F.lit(0.0),
            lambda total, i: total + F.pow(F.lit(float(backoff)), i),
        ),
    ).otherwise(F.lit(0.0))
    return chosen.withColumn("planned_wait", waits)


@per_application
def _classification(strict_status: bool) -> dict[str, Column]:
    content_type = F.coalesce("content_type", F.lit(""))
    transport = F.col("error").isNotNull()
    http = _http_failure() if strict_status else F.lit(False)
    error = (
        F.when(transport, F.col("error"))
        .when(http, _http_error())
        .when(
            ~content_type.contains(HTML_CONTENT_TYPE),
            F.concat(F.lit(NON_HTML_ERROR), content_type),
        )
    )
    status = F.when(~transport & ~http, F.col("status_code"))
    return {"status_code": status, "error": error}


def classify_fetch(fetches: DataFrame, strict_status: bool = True) -> DataFrame:
    """Decide for each response whether it is a page or a failed record.

    Transport error, then (strict mode) HTTP failure — both without status —, then a
    content type that is not HTML, which keeps its status.
    """
    # Both columns read the incoming error and status, so they are set in one projection.
    return fetches.withColumns(_classification(strict_status))


def effective_delay(
    fetches: DataFrame, delays: DataFrame, request_delay: float = 1.0
) -> DataFrame:
    """Adds ``delay``: the larger of ``request_delay`` and the host's crawl delay.

    ``delays(netloc, delay)`` has one row per host; pages of a hot host are split.
    """
    by_host = delays.select(
        F.col("netloc").alias("_domain"), F.col("delay").cast("double").alias("_delay")
    )
    placed = fetches.withColumn("_domain", get_domain(F.col("url")))
    larger = F.greatest(F.lit(float(request_delay)), F.coalesce("_delay", F.lit(0.0)))
    return (
        split_join(placed, by_host, "_domain", ["url"])
        .withColumn("delay", larger)
        .drop("_domain", "_delay")
    )


def host_wait(delayed: DataFrame) -> DataFrame:
    """Pages and total waiting time per host."""
    return delayed.groupBy(get_domain(F.col("url")).alias("host")).agg(
        F.count("*").alias("pages"), F.sum("delay").alias("total_delay")
    )


def failed_pages(records: DataFrame, limit: int = 10) -> tuple[DataFrame, DataFrame]:
    """The first ``limit`` records with an error text, and the count of all of them.

    An empty error text counts as failed elsewhere but is not listed here.
    """
    failed = records.filter("error <> ''")
    listed = failed.orderBy("seq").limit(limit).select("seq", "url", "error")
    return listed, failed.agg(F.count("*").alias("failed"))


def outcome_counts(records: DataFrame) -> DataFrame:
    """``page_count, succeeded, failed``; an empty error text is a failure."""
    return records.agg(
        F.count("*").alias("page_count"),
        F.count_if(F.col("error").isNull()).alias("succeeded"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )
