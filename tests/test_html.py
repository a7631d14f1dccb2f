"""Markup → record fields."""

import random
from html import unescape
from html.entities import html5

from pyspark.sql import functions as F

from pageloom.functions import text
from pageloom.operators.pages import page_metrics, parse_pages
from pageloom.schema import FETCH
from pageloom.functions.text import decode_entities, strip

SAMPLE = """
<html><head><title>A Test Page</title>
<meta name="description" content="What the page is about.">
<meta name="keywords" content="pages, spark, python"></head>
<body><h1>Main</h1><h2>One</h2><h2>Two</h2>
<p>First paragraph with words.</p><p>Second paragraph, more words.</p>
<a href="/inside">in</a><a href="https://else.example/page">out</a>
<a href="#section">skip</a><a href="javascript:void(0)">skip</a>
<img src="/images/photo.jpg" alt=""><img src="https://cdn.example/logo.png"></body></html>
"""


def parse(spark, *pages, url="https://example.com/"):
    rows = [
        (p[0], 200, "text/html", p[1], "", None)
        if isinstance(p, tuple)
        else (url, 200, "text/html", p, "", None)
        for p in pages
    ]
    df = spark.createDataFrame(rows, FETCH).coalesce(1)
    return parse_pages(df).collect()


def test_sample_page(spark):
    page = parse(spark, SAMPLE)[0]
    assert page["title"] == "A Test Page"
    assert page["meta_description"] == "What the page is about."
    assert page["meta_keywords"] == "pages, spark, python"
    assert page["headings"] == {"h1": ["Main"], "h2": ["One", "Two"]}
    assert page["paragraphs"] == ["First paragraph with words.", "Second paragraph, more words."]
    assert page["internal_links"] == ["https://example.com/inside"]
    assert page["external_links"] == ["https://else.example/page"]
    assert page["links"] == page["internal_links"] + page["external_links"]
    assert page["images"] == ["https://example.com/images/photo.jpg", "https://cdn.example/logo.png"]
    assert page["word_count"] == 3 + 3 + 4 + 4


def test_empty_page(spark):
    page = parse(spark, "<html></html>")[0]
    assert (page["title"], page["paragraphs"], page["links"], page["headings"]) == ("", [], [], {})
    assert page["word_count"] == 0 and page["error"] is None


def test_paragraph_text(spark):
    cases = {
        "<p>Hello <b>world</b></p>": ["Helloworld"],
        "<p>one<p>two<div>out</div>lost": ["one", "two"],
        "<p>a<br>b</p><P CLASS=x>c</P>": ["ab", "c"],
        '<script>var t="</p>";</script><p>x</p>': ["x"],
        '<p>x<script>"<p>no</p>"</script>y</p>': ["xy"],
        "<p>x <!-- <p>no</p> --> y</p>": ["xy"],
        "<p>open <!-- never closed <p>no": ["open"],
        "<p>\xa0 &nbsp;t&nbsp; </p><p> \t </p>": ["t"],
        "<p>&eacute;&#233;&#xE9; &amp;lt; &unknown; &#0;&copy</p>": ["ééé &lt; &unknown; ©"],
        "<p>1 < 2 and a>b</p>": ["1 < 2 and a>b"],
        '<p title="a > b">x</p>': ["x"],
        "<p>cut <a href='/x": ["cut"],
        "<pre>no</pre><param>no<p>yes": ["yes"],
        "<p>twice</p><p>twice</p>": ["twice", "twice"],
        "<style>p{}</style><p>x<style>y</style></p>": ["x"],
    }
    got = [r["paragraphs"] for r in parse(spark, *cases)]
    assert dict(zip(cases, got)) == cases


def test_headings(spark):
    cases = {
        "<h2>b</h2><h1>a</h1><h2> c </h2><h3></h3>": {"h1": ["a"], "h2": ["b", "c"]},
        "<h1>x <i>y</i></h1>": {"h1": ["xy"]},
        "<h1><div>in</div> side</h1><p>p": {"h1": ["inside"]},
        "<h1>open<p>para</p>": {"h1": ["open"]},
        "<header>no</header><H6>s</H6>": {"h6": ["s"]},
    }
    got = [r["headings"] for r in parse(spark, *cases)]
    assert dict(zip(cases, got)) == cases
    assert list(got[0]) == ["h1", "h2"]


def test_meta(spark):
    first_empty = '<meta name="description" content=""><meta name="description" content="x">'
    other_case = '<meta name="Description" content="x">'
    swapped = "<META content='a &quot;b&quot;' NAME=description>"
    none = "<meta charset=utf-8><meta name=description>"
    got = [r["meta_description"] for r in parse(spark, first_empty, other_case, swapped, none)]
    assert got == ["", "", 'a "b"', ""]


def test_links(spark):
    cases = {
        '<a href="/x?page=2&amp;ref=x">': ["https://example.com/x?page=2&ref=x"],
        "<a class=c HREF='/q'><a href=/u><a\nhref = \" /s \">": [
            "https://example.com/q", "https://example.com/u", "https://example.com/s"],
        '<a href="/d#1"><a href="/d#2"><a href="/d">': ["https://example.com/d"],
        '<a title="<a href=/no>" href="/yes">': ["https://example.com/yes"],
        '<!-- <a href="/no"> --><script>"<a href=/no>"</script>': [],
        '<a hrefx="/no"><a name=n><area href=/no><a data-href=/no>': [],
        '<a href=""><a href="MAILTO:x"><a href="tel:1"><a href="ftp://x/y">': [],
        '<base href="https://b.example/"><a href="r">': ["https://example.com/r"],
        '<a href="/1" href="/2">': ["https://example.com/1"],
        '<a title=x\'y href="/z">': ["https://example.com/z"],
    }
    got = [r["links"] for r in parse(spark, *cases)]
    assert dict(zip(cases, got)) == cases


def test_internal_means_equal_host(spark):
    body = '<a href="http://EX.com:80/a"><a href="http://ex.com/b"><a href="http://w.ex.com:80/c"><a href="//u@ex.com:80/d">'
    page = parse(spark, ("http://ex.com:80/p", body))[0]
    assert page["internal_links"] == ["http://EX.com:80/a"]
    assert len(page["external_links"]) == 3


def test_images_keep_any_scheme(spark):
    page = parse(spark, '<img src="i.png"><IMG SRC=i.png><img src="data:x;y,z#b"><img src=" "><image src=n>')[0]
    assert page["images"] == ["https://example.com/i.png", "data:x;y,z"]


def test_malformed_link_host_fails_the_page(spark):
    page = parse(spark, '<title>t</title><p>x</p><a href="http://[bad/x">')[0]
    assert page["error"] == "Invalid IPv6 URL"
    assert (page["status_code"], page["title"], page["paragraphs"]) == (None, "", [])


def test_named_entities(spark):
    """All names, with their semicolon, without, before letters and before more names."""
    texts = [f"x&{n}y" for n in html5] + [f"&{n}&{n} &{n}" for n in html5]
    texts += ["&notit;", "&ampamp;", "&amp;lt;", "&&amp;&", "&unknown; &amp", "a&b&c=&copy=1", "&#65&#x42;&#;&#x;", "&ltx"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    got = dict(df.select("i", decode_entities(F.col("t"))).collect())
    numeric = {len(texts) - 2: "AB&#;&#x;"}
    for i, t in enumerate(texts):
        assert got[i] == numeric.get(i, unescape(t)), t


def test_names_in_attributes_need_their_end(spark):
    page = parse(spark, '<a href="/?a=1&copy=2&reg&lt;x&amp;b&notit=3&copy">l</a>')[0]
    assert page["links"] == ["https://example.com/?a=1&copy=2®<x&b&notit=3©"]


def test_strip_equals_python(spark):
    blanks = [c for c in map(chr, range(0x110000)) if c.isspace()]
    values = [f"{a}x{a} y{a}" for a in blanks] + ["​x", "\x00x", "\x08"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [tuple(r) for r in df.select(strip(F.col("v")), text.count_words(F.col("v"))).collect()]
    assert got == [(v.strip(), len(v.split())) for v in values]


def test_long_pages_do_not_exhaust_the_stack(spark):
    body = "<p>" + "word " * 200_000 + "<a " + "x=1 " * 50_000 + "href='/l'>" + "<b>" * 50_000
    page = parse(spark, body)[0]
    assert page["word_count"] == 200_000 and page["links"] == ["https://example.com/l"]


def test_text_order_is_seeded_noise_proof(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("ab é") for _ in range(8)) for _ in range(50)]
    page = parse(spark, "".join(f"<p>{w}</p>" for w in words))[0]
    assert page["paragraphs"] == [w.strip() for w in words if w.strip()]


def test_metrics(spark):
    df = spark.createDataFrame([("https://example.com/", 200, "text/html", SAMPLE, "", None)], FETCH)
    row = page_metrics(parse_pages(df, depth=1)).first()
    assert (row["num_headings"], row["num_paragraphs"], row["num_images"]) == (3, 2, 2)
    assert row["num_links"] == row["num_internal_links"] + row["num_external_links"] == 2
    assert (row["error"], row["depth"]) == ("", 1)


def test_filters_on_records_do_not_repeat_the_parse(spark):
    df = spark.createDataFrame([("https://example.com/", 200, "text/html", SAMPLE, "", None)], FETCH)
    records = parse_pages(df).filter("error IS NULL AND size(links) > 1").select("title")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<!--") == 1
