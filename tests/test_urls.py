"""URL functions: literal cases, and random pairs against the standard library."""

import random
from urllib.parse import urldefrag, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from pageloom.functions import urls

BASE = "https://Ex.com:8080/a/b/c?q=1#f"
CASES = [
    ("https://example.com/blog/", "../about", "https://example.com/about"),
    ("https://example.com", "/page#section-2", "https://example.com/page"),
    ("https://example.com", "https://other.com/x", "https://other.com/x"),
    ("https://example.com", "about", "https://example.com/about"),
    ("https://example.com", "?a=1", "https://example.com?a=1"),
    ("https://example.com", "JavaScript:void(0)", "JavaScript:void(0)"),
    (BASE, "../x", "https://Ex.com:8080/a/x"),
    (BASE, "../../../x", "https://Ex.com:8080/x"),
    (BASE, "./y", "https://Ex.com:8080/a/b/y"),
    (BASE, "?z=1", "https://Ex.com:8080/a/b/c?z=1"),
    (BASE, "#frag", "https://Ex.com:8080/a/b/c?q=1"),
    (BASE, "", "https://Ex.com:8080/a/b/c?q=1"),
    (BASE, "//cdn.com/i.png", "https://cdn.com/i.png"),
    (BASE, "/p#s", "https://Ex.com:8080/p"),
    (BASE, "HTTP://O.com/X", "HTTP://O.com/X"),
    (BASE, "data:image/png;base64,AA#b", "data:image/png;base64,AA"),
    (BASE, "g;x=1", "https://Ex.com:8080/a/b/g;x=1"),
    (BASE, "page two", "https://Ex.com:8080/a/b/page two"),
    (BASE, "./", "https://Ex.com:8080/a/b/"),
    (BASE, "..", "https://Ex.com:8080/a/"),
    (BASE, "a//b", "https://Ex.com:8080/a/b/a/b"),
    (BASE, "/a/./b/../c", "https://Ex.com:8080/a/c"),
    (BASE, "x?y=/../z", "https://Ex.com:8080/a/b/x?y=/../z"),
    (BASE, "http:foo", "http:foo"),
    (BASE, "https:foo", "https://Ex.com:8080/a/b/foo"),
    (BASE, "http://[bad/x", None),
    ("http://[bad/x", "y", None),
]


def _resolve(spark, pairs):
    df = spark.createDataFrame(
        [(i, b, l) for i, (b, l) in enumerate(pairs)], "i int, base string, link string"
    )
    rows = df.select("i", urls.normalize_url(F.col("base"), F.col("link")).alias("u")).collect()
    return [r["u"] for r in sorted(rows)]


def test_literal_cases(spark):
    got = _resolve(spark, [(b, l) for b, l, _ in CASES])
    assert got == [want for *_, want in CASES]


def test_random_pairs_equal_the_standard_library(spark):
    rng = random.Random(7)
    atoms = ["a", "B", "..", ".", "/", "//", "?", "x=1", "&", "é", " ", "%20", ":", "=", "b.c",
             "\t", "|", "@", "http:", "https:", "mailto:", "ex.com", "+", "~"]
    bases = ["https://ex.com", "https://ex.com/", "http://ex.com/a/b", "https://u@ex.com:8/a//b/?q#f",
             "https://ex.com/a/../b/c", "http://ex.com?x=1", "https://EX.com/a;p/b"]
    pairs = []
    for _ in range(6000):
        link = "".join(rng.choice(atoms) for _ in range(rng.randint(0, 7)))
        if rng.random() < 0.3:
            link += "#" + rng.choice(["", "f", "a/b?c"])
        pairs.append((rng.choice(bases), link))
    want = [urldefrag(urljoin(b, l.strip()))[0] for b, l in pairs]
    got = _resolve(spark, pairs)
    wrong = [(p, w, g) for p, w, g in zip(pairs, want, got) if w != g]
    assert not wrong, wrong[:10]


def test_parts_and_classes(spark):
    samples = ["https://example.com/path?x=1", "http://U:p@Blog.Example.com:80/", "ftp://h/x",
               "mailto:test@example.com", "javascript:void(0)", "HTTPS://h", "//h/p", "p?q#f", "",
               "https://ex.com/a|b c", "1http://x/", ":x", " http://h/"]
    url = F.col("url")
    rows = (
        spark.createDataFrame([(u,) for u in samples], "url string")
        .select("url", urls.url_parts(url).alias("p"), urls.get_domain(url).alias("d"),
                urls.is_crawlable_scheme(url).alias("c"))
        .collect()
    )
    for row in rows:
        want = urlparse(row["url"])
        path = want.path + (f";{want.params}" if want.params else "")
        assert tuple(row["p"]) == (want.scheme, want.netloc, path, want.query, want.fragment)
        assert row["d"] == want.netloc.lower()
        assert row["c"] == (want.scheme in ("http", "https"))


@pytest.mark.parametrize(
    "url, root, want",
    [
        ("https://example.com/page", "example.com", True),
        ("https://blog.example.com/page", "EXAMPLE.com", True),
        ("https://other.com/page", "example.com", False),
        ("https://notexample.com/", "example.com", False),
    ],
)
def test_same_domain(spark, url, root, want):
    row = spark.range(1).select(urls.is_same_domain(F.lit(url), F.lit(root)).alias("x")).first()
    assert row["x"] is want
