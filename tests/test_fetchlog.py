"""Attempts, classification, delays, failures."""

import random

import pytest
from pyspark.sql import functions as F

from pageloom.operators import fetchlog
from pageloom.schema import FETCH, with_defaults

ATTEMPT = "url string, attempt int, status_code int, content_type string, body string, error string"


def test_collapse_attempts(spark):
    rows = [
        ("a", 1, None, None, None, "e1"), ("a", 2, None, None, None, "e2"), ("a", 3, 200, "t", "b3", None),
        ("b", 1, None, None, None, "e1"), ("b", 2, None, None, None, "e2"), ("b", 3, None, None, None, "e3"),
        ("c", 1, 503, "t", "x", None), ("c", 2, 200, "t", "y", None),
        ("d", 1, 200, "t", "first", None), ("d", 2, 200, "t", "second", None),
    ]
    df = spark.createDataFrame(rows, ATTEMPT)

    def run(retries, strict=True):
        got = fetchlog.collapse_attempts(df, retries, 2.0, strict).collect()
        return {r["url"]: (r["attempts_used"], r["body"], r["error"], r["planned_wait"]) for r in got}

    assert run(3) == {
        "a": (3, "b3", None, 6.0), "b": (3, None, "e3", 6.0), "c": (2, "y", None, 2.0), "d": (1, "first", None, 0.0),
    }
    assert run(2)["a"] == (2, None, "e2", 2.0)
    assert run(3, strict=False)["c"] == (1, "x", None, 0.0)


def test_collapse_attempts_of_one_hot_url(spark):
    rng = random.Random(1)
    attempts = list(range(1, 2001))
    rng.shuffle(attempts)
    rows = [("hot", i, 200 if i == 1500 else None, "t", str(i), None if i == 1500 else f"e{i}") for i in attempts]
    row = fetchlog.collapse_attempts(spark.createDataFrame(rows, ATTEMPT), 2000, 1.0).first()
    assert (row["attempts_used"], row["body"], row["planned_wait"]) == (1500, "1500", 1499.0)


def test_collapse_attempts_moves_one_row_per_url_and_task(spark):
    rows = [("u", 1, 200, "t", body, None) for body in ("b", "a", "b", None)] + [(None, 1, None, None, None, "e")]
    df = spark.createDataFrame(rows, ATTEMPT).repartition(4)
    got = fetchlog.collapse_attempts(df)
    assert len({r["body"] for r in got.collect() if r["url"] == "u"}) == 1
    assert sorted(map(str, (r["url"] for r in got.collect()))) == ["None", "u"]
    again = fetchlog.collapse_attempts(df.repartition(1))
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))
    plan = fetchlog.collapse_attempts(df)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and plan.count("WindowGroupLimit") == 2
    assert plan.index(", Final") < plan.index("Exchange hashpartitioning(url") < plan.index(", Partial")
    mapped = df.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))
    assert fetchlog.collapse_attempts(mapped).count() == 2
    assert fetchlog.collapse_attempts(df.limit(0)).count() == 0


def test_classify(spark):
    rows = [
        ("ok", 200, "text/html; charset=utf-8", "b", "", None),
        ("gone", 404, "text/html", "b", "", None),
        ("odd", 599, "text/html", "b", "", None),
        ("pdf", 200, "application/pdf", "b", "", None),
        ("upper", 200, "Text/HTML", "b", "", None),
        ("none", 200, None, "b", "", None),
        ("down", 500, "text/html", "b", "", "reset"),
        ("silent", None, None, None, "", ""),
    ]
    df = spark.createDataFrame(rows, FETCH)

    def run(strict):
        return {r["url"]: (r["status_code"], r["error"]) for r in fetchlog.classify_fetch(df, strict).collect()}

    assert run(True) == {
        "ok": (200, None),
        "gone": (None, "404 Client Error: Not Found for url: gone"),
        "odd": (None, "599 Server Error:  for url: odd"),
        "pdf": (200, "Non-HTML content-type: application/pdf"),
        "upper": (200, "Non-HTML content-type: Text/HTML"),
        "none": (200, "Non-HTML content-type: "),
        "down": (None, "reset"),
        "silent": (None, ""),
    }
    lenient = run(False)
    assert lenient["gone"] == (404, None) and lenient["odd"] == (599, None)
    assert lenient["down"] == (None, "reset")


def test_delays(spark):
    fetched = spark.createDataFrame([("https://A/x",), ("http://a/y",), ("http://b/",)], "url string")
    delays = spark.createDataFrame([("a", 5), ("c", 9)], "netloc string, delay int")
    delayed = fetchlog.effective_delay(fetched, delays, 1.0)
    assert sorted(tuple(r) for r in delayed.collect()) == [
        ("http://a/y", 5.0), ("http://b/", 1.0), ("https://A/x", 5.0),
    ]
    assert sorted(tuple(r) for r in fetchlog.host_wait(delayed).collect()) == [("a", 2, 10.0), ("b", 1, 1.0)]


@pytest.fixture
def records(spark):
    errors = [None, "", "x"] + ["late"] * 20
    rows = [(i, f"u{i}", e) for i, e in enumerate(errors)]
    return with_defaults(spark.createDataFrame(rows, "seq bigint, url string, error string"), "seq")


def test_failures(spark, records):
    listed, count = fetchlog.failed_pages(records)
    assert [r["seq"] for r in listed.collect()] == list(range(2, 12))
    assert count.first()["failed"] == 21
    assert tuple(fetchlog.outcome_counts(records).first()) == (23, 1, 22)
