"""Captured responses → page records. Row-local: no shuffle, no Python in tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import html, text, urls
from ..functions.reuse import per_application
from ..schema import RECORD_FIELDS, default_value, PAGE_RECORD


_RAW = ("url", "status_code", "content_type", "body", "fetched_at", "error", "depth")
_CARRIED = ("url", "status_code", "fetched_at", "error", "depth")


@per_application
def _parse_steps() -> tuple[dict[str, Column], ...]:
    """The projections of ``parse_pages``; they name columns only and fit every input."""
    m, base = F.col("_marked"), F.col("_base")
    marked = {
        "_marked": html.mark_tags(F.when(F.col("error").isNull(), F.col("body"))),
        "_base": urls.base_parts(F.col("url")),
    }
    opened = {
        "_title": html.page_title(m),
        "_metas": html.meta_elements(m),
        "_blocks": html.block_text(m),
        "_hrefs": F.transform(html.href_values(m), lambda h: urls.resolve(base, h)),
        "_srcs": F.transform(html.src_values(m), lambda s: urls.resolve(base, s)),
        "_domain": F.lower(base["netloc"]),
        "_base": base,
    }
    hrefs, srcs = F.col("_hrefs"), F.col("_srcs")
    malformed = (
        F.col("_base.self").isNull()
        | F.exists(hrefs, lambda u: u.isNull())
        | F.exists(srcs, lambda u: u.isNull())
    )
    crawlable = F.array_distinct(F.filter(hrefs, urls.is_crawlable_scheme))
    extracted = {
        "_title": F.col("_title"),
        "_metas": F.col("_metas"),
        "_heads": html.heading_elements(F.col("_blocks")),
        "_paras": html.paragraphs(F.col("_blocks")),
        "_links": F.transform(
            crawlable,
            lambda u: F.struct(
                u.alias("url"), (urls.get_domain(u) == F.col("_domain")).alias("internal")
            ),
        ),
        "_images": F.array_distinct(srcs),
        "_failed": F.col("error").isNull() & F.coalesce(malformed, F.lit(False)),
    }
    link = F.col("_links")
    shaped = {
        "_failed": F.col("_failed"),
        "title": F.col("_title"),
        "meta_description": html.meta_content(F.col("_metas"), "description"),
        "meta_keywords": html.meta_content(F.col("_metas"), "keywords"),
        "headings": html.headings(F.col("_heads")),
        "paragraphs": F.col("_paras"),
        "links": link["url"],
        "internal_links": F.filter(link, lambda x: x["internal"])["url"],
        "external_links": F.filter(link, lambda x: ~x["internal"])["url"],
        "images": F.col("_images"),
    }
    failed = F.col("_failed")
    words = text.count_words(
        text.full_text(F.col("title"), F.col("headings"), F.col("paragraphs"))
    )
    values = {name: F.col(name) for name in RECORD_FIELDS if name != "word_count"}
    values["word_count"] = words.cast("int")
    final = {
        name: F.coalesce(
            F.when(F.col("error").isNull() & ~failed, value),
            default_value(PAGE_RECORD[name]),
        )
        for name, value in values.items()
    }
    final["error"] = F.when(failed, urls.INVALID_NETLOC).otherwise(F.col("error"))
    final["status_code"] = F.when(~failed, F.col("status_code"))
    final |= {name: F.col(name) for name in ("url", "fetched_at", "depth")}
    return marked, opened, extracted, shaped, {n: final[n] for n in RECORD_FIELDS}


def parse_pages(fetches: DataFrame, depth: int = 0) -> DataFrame:
    """Page records of classified fetches ``(url, status_code, body, fetched_at, error)``.

    Rows with an error keep the empty defaults. A page that holds a link with a
    malformed host becomes a failed record. A ``depth`` column wins over the argument;
    other columns (``seq`` and the like) pass through. Also runs on a stream.

    Each step's results are referenced several times by the next one, which keeps
    Catalyst from merging the projections and evaluating the markup twice; unused
    branches are pruned when the caller selects a few fields.

    The result counts its rows under a metric of its own (``parse_pages-…``). That also
    fences the parse: Catalyst does not move a caller's filter, or the one it infers for
    ``explode``, below the metric, where each would repeat the parse to test one field.
    Filters on the input columns belong on ``fetches``.
    """
    passed = [c for c in fetches.columns if c not in _RAW]
    level = F.col("depth") if "depth" in fetches.columns else F.lit(depth)
    df = fetches.select(
        *passed,
        "url",
        F.col("status_code").cast("int").alias("status_code"),
        "body",
        F.coalesce("fetched_at", F.lit("")).alias("fetched_at"),
        "error",
        level.cast("int").alias("depth"),
    )
    *steps, final = _parse_steps()
    for step in steps:
        df = df.select(*passed, *_CARRIED, *(c.alias(n) for n, c in step.items()))
    records = df.select(*passed, *(c.alias(n) for n, c in final.items()))
    return records.observe(f"parse_pages-{uuid.uuid4().hex}", F.count("*").alias("rows"))


def record_text(records: DataFrame) -> Column:
    """Searchable text of a record."""
    return text.full_text(
        records["title"], records["headings"], records["paragraphs"]
    )


def page_metrics(records: DataFrame) -> DataFrame:
    """The flat counts of each record; a null error shows as empty text."""
    headings = F.aggregate(
        F.map_values("headings"), F.lit(0), lambda n, texts: n + F.size(texts)
    )
    keep = [c for c in ("seq",) if c in records.columns]
    return records.select(
        *keep,
        "url",
        "status_code",
        "title",
        "meta_description",
        "meta_keywords",
        "depth",
        "word_count",
        headings.alias("num_headings"),
        F.size("paragraphs").alias("num_paragraphs"),
        F.size("links").alias("num_links"),
        F.size("internal_links").alias("num_internal_links"),
        F.size("external_links").alias("num_external_links"),
        F.size("images").alias("num_images"),
        "fetched_at",
        F.coalesce("error", F.lit("")).alias("error"),
    )
