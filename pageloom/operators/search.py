"""Keyword search and keyword frequency over page records (with their ``seq``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import text
from ..plans.stages import BROADCAST_ROWS, fits, materialize
from .pages import record_text

# A record's token position is below 2^31, so (seq, position) packs into one decimal.
_POSITIONS = 2**31
SALTS = 64


def _check_limit(limit: int) -> None:
    if limit < 0:
        raise ValueError("limit must be >= 0")


def keyword_search(records: DataFrame, keyword: str, limit: int = 10) -> DataFrame:
    """Records ranked by whole-word hits of ``keyword``: ``url, title, score, snippet``.

    Ties keep visit order. Scores and snippets are made in the scan, so only short rows
    enter the top-k; each task keeps ``limit`` of them.
    """
    _check_limit(limit)
    keyword = keyword.lower()
    texts = records.select("seq", "url", "title", record_text(records).alias("_text"))
    score = text.whole_word_count(F.lower("_text"), keyword)
    # Rows without a hit vanish inside the expression: as a filter on the score, Spark
    # would count twice, once to test and once to project.
    scored = F.filter(
        F.array(F.struct(score.alias("score"), F.col("_text").alias("text"))),
        lambda hit: hit["score"] > 0,
    )
    shown = F.transform(
        scored,
        lambda hit: F.struct(
            hit["score"].alias("score"),
            text.snippet(hit["text"], F.lit(keyword)).alias("snippet"),
        ),
    )
    hits = texts.select("seq", "url", "title", F.inline(shown))
    ranked = hits.orderBy(F.desc("score"), "seq").limit(limit)
    return ranked.select("url", "title", "score", "snippet")


def _top_by_keyword(scores: DataFrame, limit: int, *keys: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "seq")
    rank = F.row_number().over(order).cast("bigint")
    return scores.withColumn("rank", rank).filter(F.col("rank") <= limit)


def keyword_search_batch(
    records: DataFrame, keywords: DataFrame, limit: int = 10, stored: bool = False
) -> DataFrame:
    """Top ``limit`` records for every row of ``keywords(keyword)``.

    Single words only (letters, digits, underscore); anything else raises an error when
    the query runs. One pass over the texts serves all keywords, a second one fetches the
    texts of the best records; the texts are kept as a stage between them, so that pages
    are parsed once. With ``stored`` the records come from storage as they are and are
    scanned twice instead. A keyword table of
    counted, bounded size is broadcast, so only matching words are shuffled; a larger
    one meets the words after they are counted per record, spread over salted keys. In
    either case the rank limit is applied to parts of a word's records before they come
    together, whatever ``limit`` is.
    ``keyword, rank, seq, url, title, score, snippet``.
    """
    _check_limit(limit)
    word = F.lower("keyword")
    wanted = keywords.select(
        F.when(word.rlike(rf"\A{text.WORD_CHAR}+\z"), word)
        .otherwise(F.raise_error(F.concat(F.lit("not a single word: "), F.col("keyword"))))
        .alias("keyword")
    )
    small = fits(wanted, BROADCAST_ROWS // max(limit, 1))
    texts = records.select("seq", "url", "title", record_text(records).alias("_text"))
    if not stored:
        texts = materialize(texts, "texts")
    words = texts.select(
        "seq",
        F.explode(
            F.regexp_extract_all(F.lower("_text"), F.lit(f"{text.WORD_CHAR}++"), F.lit(0))
        ).alias("keyword"),
    )
    if small:
        words = words.join(F.broadcast(wanted.distinct()), "keyword")
    scores = words.groupBy("keyword", "seq").agg(F.count("*").alias("score"))
    # A word in every record would gather all of them in one task, in the join and in the
    # ranking; both work on parts of its records first.
    scores = scores.withColumn("part", F.pmod(F.hash("seq"), F.lit(SALTS)))
    if not small:
        parts = wanted.select(
            "keyword", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part")
        ).distinct()
        scores = scores.join(parts, ["keyword", "part"])
    scores = _top_by_keyword(scores, limit, "keyword", "part").drop("rank")
    best = _top_by_keyword(scores, limit, "keyword")
    # At most (keywords x limit) rows fetch their texts in a second scan.
    found = texts.join(F.broadcast(best) if small else best, "seq")
    return found.select(
        "keyword",
        "rank",
        "seq",
        "url",
        "title",
        "score",
        text.snippet(F.col("_text"), F.col("keyword")).alias("snippet"),
    )


def keyword_counts(records: DataFrame) -> DataFrame:
    """``word, count, first_seen`` of all counted words.

    Partial counts are formed in each task, so frequent words do not skew the shuffle.
    ``first_seen`` packs (seq, token position) into one number: a fixed-width buffer
    keeps this a hash aggregation where a struct would force a sort.
    """
    tokens = records.select(
        "seq", F.posexplode(text.tokenize(record_text(records))).alias("pos", "word")
    )
    first = F.col("seq").cast("decimal(19,0)") * F.lit(_POSITIONS).cast(
        "decimal(10,0)"
    ) + F.col("pos").cast("decimal(10,0)")
    return tokens.groupBy("word").agg(
        F.count("*").alias("count"), F.min(first).alias("first_seen")
    )


def keyword_frequency(records: DataFrame, top_n: int = 25) -> DataFrame:
    """The ``top_n`` words as ``word, count, rank``; ties by first appearance."""
    _check_limit(top_n)
    top = keyword_counts(records).orderBy(F.desc("count"), "first_seen").limit(top_n)
    # top_n rows are left, so the one-partition window is bounded by the request.
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "first_seen"))
    return top.select("word", "count", rank.cast("bigint").alias("rank"))
