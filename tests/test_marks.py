"""Page text that holds the characters used as marks inside the parse."""

from pageloom.operators.pages import parse_pages
from pageloom.sources.fetches import fetches_from_pages


def test_marks_in_a_page_lose_no_text(spark):
    html = "<title>a﷐b</title><p>one ﷑two﷒ three</p><a href='/x﷐'>l</a>"
    pages = spark.createDataFrame([(1, "https://a.example/", html)], "page_id long, url string, html string")
    record = parse_pages(fetches_from_pages(pages)).first()
    assert record["title"] == "a\ufdd0b"
    assert record["paragraphs"] == ["one \ufdd1two\ufdd2 three"]
    assert record["links"] == ["https://a.example/x"]


def test_references_to_marks_cut_nothing(spark):
    html = "<p>one &#xFDD0;two three</p><h1>a&#64977;b<p>c &#64978; d</p>"
    pages = spark.createDataFrame([(1, "https://a.example/", html)], "page_id long, url string, html string")
    record = parse_pages(fetches_from_pages(pages)).first()
    assert record["paragraphs"] == ["one \ufdd0two three", "c \ufdd2 d"]
    assert record["headings"] == {"h1": ["a\ufdd1b"]}
