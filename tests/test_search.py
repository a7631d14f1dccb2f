"""Search and frequency against plain Python over random texts."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pageloom.functions import text
from pageloom.operators import search
from pageloom.operators.pages import parse_pages
from pageloom.schema import with_defaults


def _records(spark, rows):
    """rows: (url, title, headings, paragraphs)"""
    schema = "seq bigint, url string, title string, headings map<string,array<string>>, paragraphs array<string>"
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    return with_defaults(df, "seq")


def _text(row):
    _, title, headings, paragraphs = row
    return " ".join([title, " ".join(h for hs in headings.values() for h in hs), " ".join(paragraphs)])


def _snippet(body, word):
    at = body.lower().find(word)
    if at < 0:
        return body[:120].strip() + ("..." if len(body) > 120 else "")
    lo, hi = max(0, at - 60), min(len(body), at + len(word) + 60)
    return ("..." if lo else "") + body[lo:hi].strip() + ("..." if hi < len(body) else "")


def _search(rows, keyword, limit):
    word = keyword.lower()
    pattern = re.compile(rf"\b{re.escape(word)}\b")
    hits = []
    for row in rows:
        body = _text(row)
        score = len(pattern.findall(body.lower()))
        if score:
            hits.append((row[0], row[1], score, _snippet(body, word)))
    return sorted(hits, key=lambda h: -h[2])[:limit]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = ["spark", "Spark", "sparks", "c++", "c++x", "año", "ÉTÉ", "été", "x_y", "don't",
                  "the", "data-base", "data", "base", "ab", "99", "e.g.", "a|b", "naïve", "...", "q"]
    made = []
    for i in range(120):
        paragraphs = [
            " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))
            for _ in range(rng.randint(0, 3))
        ]
        headings = {"h1": [rng.choice(vocabulary)]} if rng.random() < 0.5 else {}
        made.append((f"https://e.example/{i}", rng.choice(vocabulary), headings, paragraphs))
    return made


@pytest.mark.parametrize(
    "keyword", ["spark", "SPARK", "c++", "été", "x_y", "data", "data base", "don't", "e.g.", "zzz", "", "|", "q"]
)
def test_keyword_search(spark, rows, keyword):
    found = search.keyword_search(_records(spark, rows), keyword, limit=15)
    assert found.columns == ["url", "title", "score", "snippet"]
    assert [tuple(r) for r in found.collect()] == _search(rows, keyword, 15)


def test_limits(spark, rows):
    records = _records(spark, rows)
    assert search.keyword_search(records, "spark", limit=0).collect() == []
    with pytest.raises(ValueError):
        search.keyword_search(records, "spark", limit=-1)


@pytest.mark.parametrize("small", [True, False])
def test_batch_search(spark, rows, small, monkeypatch):
    if not small:  # the way for keyword tables beyond the broadcast bound
        monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    words = ["Spark", "été", "data", "missing", "q", "q", "99"]
    keywords = spark.createDataFrame([(w,) for w in words], "keyword string")
    got = search.keyword_search_batch(_records(spark, rows), keywords, limit=3).collect()
    want = {
        (w.lower(), rank, *hit)
        for w in words
        for rank, hit in enumerate(_search(rows, w, 3), 1)
    }
    assert {(r["keyword"], r["rank"], r["url"], r["title"], r["score"], r["snippet"]) for r in got} == want
    assert len(got) == len(want)


def test_batch_search_parses_pages_once(spark):
    rows = [("https://h/1", 200, "<title>T</title><p>one two two", "", None, 1), ("https://h/2", 200, "<p>two", "", None, 2)]
    fetched = spark.createDataFrame(rows, "url string, status_code int, body string, fetched_at string, error string, seq bigint")
    keywords = spark.createDataFrame([("two",)], "keyword string")
    found = search.keyword_search_batch(parse_pages(fetched), keywords)
    assert "CollectMetrics" not in found._jdf.queryExecution().toString()
    assert [(r["seq"], r["score"]) for r in found.orderBy("rank").collect()] == [(1, 2), (2, 1)]


def test_batch_search_rejects_phrases(spark, rows):
    keywords = spark.createDataFrame([("two words",)], "keyword string")
    with pytest.raises(Exception, match="not a single word"):
        search.keyword_search_batch(_records(spark, rows), keywords).collect()


def test_keyword_frequency(spark, rows):
    counter = Counter()
    for row in rows:
        counter.update(
            w for w in re.findall(r"[A-Za-z0-9']+", _text(row).lower())
            if w not in text.STOP_WORDS and len(w) > 2
        )
    for top in (3, 25):
        got = search.keyword_frequency(_records(spark, rows), top_n=top).collect()
        assert [(r["word"], r["count"]) for r in got] == counter.most_common(top)
        assert [r["rank"] for r in got] == list(range(1, len(got) + 1))


def test_stop_words():
    assert len(text.STOP_WORDS) == len(set(text.STOP_WORDS)) == 59


def test_frequency_ties_follow_first_appearance(spark):
    rows = [("u0", "", {}, ["zeta beta"]), ("u1", "", {}, ["alpha beta zeta alpha"])]
    got = search.keyword_frequency(_records(spark, rows), top_n=10).collect()
    assert [r["word"] for r in got] == ["zeta", "beta", "alpha"]


def test_snippet_without_hit(spark):
    long, short = "x" * 130, " short "
    df = spark.createDataFrame([(long,), (short,)], "t string")
    got = [r[0] for r in df.select(text.snippet(F.col("t"), F.lit("zz"))).collect()]
    assert got == ["x" * 120 + "...", "short"]


def test_search_plan_is_a_top_k_without_full_sort(spark, rows):
    found = search.keyword_search(_records(spark, rows), "spark")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
