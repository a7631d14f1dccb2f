"""Robots rules against the standard library's parser."""

import random
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from pageloom.operators import robots
from pageloom.plans.stages import materialize
from pageloom.sources.robots import one_per_host

AGENT = "PageBot/1.0 (+https://bot.example)"
ROBOTS = "netloc string, http_status int, body string"


def _oracle(status, body, url):
    """(allowed, delay) as a fetcher built on the standard library answers."""
    if status is None:
        return True, None
    parser = RobotFileParser()
    if status in (401, 403):
        parser.disallow_all = True
    elif 400 <= status < 500:
        parser.allow_all = True
    elif status < 400:
        parser.parse(body.splitlines())
    return parser.can_fetch(AGENT, url), parser.crawl_delay(AGENT)


def _check(spark, files, paths):
    answers = spark.createDataFrame(
        [(f"h{i}.example", status, body) for i, (status, body) in enumerate(files)], ROBOTS
    )
    wanted, rows = {}, []
    for i, (status, body) in enumerate(files):
        for path in paths:
            url = f"https://h{i}.example{path}"
            rows.append((url,))
            wanted[url] = _oracle(status, body, url)
    policy = robots.robots_policy(answers, AGENT).cache()
    got = robots.robots_allowed(spark.createDataFrame(rows, "url string"), policy).collect()
    wrong = [
        (r["url"], files[int(r["url"][9:].split(".")[0])], wanted[r["url"]])
        for r in got
        if r["allowed"] != wanted[r["url"]][0]
    ]
    assert not wrong, wrong[:5]
    assert len(got) == len(rows)
    delays = {r["netloc"]: r["delay"] for r in robots.crawl_delay(policy).collect()}
    for i, (status, body) in enumerate(files):
        want = _oracle(status, body, f"https://h{i}.example/")[1]
        assert delays[f"h{i}.example"] == want, (status, body)


PATHS = ["/", "", "/a", "/a/b", "/a?q", "/a?q=1", "/b%20c", "/b c", "/B", "/%61", "/a%2Fb", "/x+y",
         "/é", "/%C3%A9", "/a;p", "/*", "//a", "/a%zz", "?q", "/a#f"]


def test_written_cases(spark):
    files = [
        (200, "User-agent: *\nAllow: /a/b\nDisallow: /a\n"),
        (200, "User-agent: *\nDisallow:\n"),
        (200, "User-agent: other\nUser-agent: pagebot\nDisallow: /a\nCrawl-delay: 5\n"),
        (200, "User-agent: *\n\nDisallow: /a\n"),
        (200, "User-agent: *\n# note\n  \nDisallow: /a\n"),
        (200, "User-agent: *\nDisallow: /\n\nUser-agent: PageBot\nDisallow: /b\nCrawl-delay: 1.5\n"),
        (200, "Disallow: /a\nUser-agent: *\nDisallow: /b%20c\nCrawl-delay: 3\nCrawl-delay: 4"),
        (200, "User-agent: *\nDisallow: /a\nUser-agent: *\nDisallow: /b\n"),
        (200, "User-agent: *\nDisallow: *\nDisallow: /a?\n"),
        (200, "user-AGENT : pagebot # x\r\nDISALLOW : /%61/b\rRequest-rate: 1/5\n"),
        (200, "User-agent: pagebot\nCrawl-delay: 7\n\nUser-agent: *\nDisallow: /\n"),
        (200, ""), (204, ""), (401, ""), (403, ""), (404, ""), (503, ""), (None, ""),
    ]
    _check(spark, files, PATHS)


def test_random_files(spark):
    rng = random.Random(5)
    keys = ["User-agent", "user-agent", "Disallow", "Allow", "Crawl-delay", "Sitemap", "Host", "Request-rate"]
    values = ["*", "pagebot", "Page", "other", "", "/", "/a", "/a/b", "/b%20c", "/b c", "/é", "/a?", "/x+y",
              "5", "2.5", "1/3", "/a # c", "#", "/%61", "*/a"]
    files = []
    for _ in range(250):
        lines = []
        for _ in range(rng.randint(1, 12)):
            lines.append(rng.choice([f"{rng.choice(keys)}: {rng.choice(values)}"] * 8 + ["", " ", "# c", "junk"]))
        files.append((200, "\n".join(lines)))
    _check(spark, files, PATHS)


def test_rules_table(spark):
    body = "User-agent: a\nUser-agent: *\nDisallow: /x\nAllow: /\n\nUser-agent: b\nCrawl-delay: 3\n"
    rows = robots.robots_rules(spark.createDataFrame([("h", 200, body)], ROBOTS)).collect()
    got = [(r["entry_id"], r["agents"], r["is_default"], r["allow"], r["path_prefix"], r["delay"]) for r in rows]
    assert sorted(got, key=str) == [
        (1, ["a", "*"], True, False, "/x", None),
        (1, ["a", "*"], True, True, "/", None),
        (2, ["b"], False, None, None, 3),
    ]


def test_disabled_and_missing(spark):
    urls = spark.createDataFrame([("https://h/x",)], "url string")
    answers = spark.createDataFrame([("h", 401, "")], ROBOTS)
    policy = robots.robots_policy(answers, AGENT)
    assert robots.robots_allowed(urls, policy, enabled=False).first()["allowed"] is True
    assert robots.robots_allowed(urls, None).first()["allowed"] is True
    assert robots.robots_allowed(urls, policy).first()["allowed"] is False
    assert robots.crawl_delay(policy, enabled=False).first()["delay"] is None


def test_hosts_share_one_answer(spark):
    rows = [("H.example", 404, ""), ("h.example", 404, "")]
    got = one_per_host(spark.createDataFrame(rows, ROBOTS)).collect()
    assert [tuple(r) for r in got] == [("h.example", 404, "")]


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_verdict_join_keeps_every_url_once(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        body = "User-agent: *\nDisallow: /a\nDisallow: /a/b\nAllow: /"
        policy = robots.robots_policy(spark.createDataFrame([("h", 200, body)], ROBOTS), AGENT)
        urls = spark.createDataFrame([(f"https://h/a/b/{i}",) for i in range(50)], "url string")
        got = robots.robots_allowed(urls, policy).collect()
        assert len(got) == 50 and not any(r["allowed"] for r in got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_an_answered_copy_beats_an_unreachable_one(spark):
    from pageloom.sources.robots import one_per_host

    copies = [("A.example", None, None), ("a.example", 200, "User-agent: *\nDisallow: /")]
    rows = spark.createDataFrame(copies, "netloc string, http_status int, body string")
    assert [tuple(r)[1] for r in one_per_host(rows).collect()] == [200]


def test_host_with_very_many_rules(spark):
    """50,000 rules of a few lengths: each URL is cut four times, whatever the rules."""
    lines = "".join(f"Disallow: /{n:05d}\nAllow: /{n:05d}/ok\n" for n in range(0, 50_000, 2))
    answers = spark.createDataFrame([("big.example", 200, "User-agent: *\n" + lines)], "netloc string, http_status int, body string")
    policy = materialize(robots.robots_policy(answers, "bot"), "policy")
    assert robots.rule_index(policy).count() == 50_000
    urls = spark.range(20_000).select(
        F.concat(F.lit("https://big.example/"), F.lpad(F.col("id").cast("string"), 5, "0"),
                 F.when(F.col("id") % 3 == 0, "/ok/x").otherwise("")).alias("url"), "id"
    )
    got = robots.robots_allowed(urls, policy)
    # The first rule that fits decides, so a longer Allow behind it changes nothing.
    assert got.count() == 20_000
    assert got.filter(F.col("allowed") != (F.col("id") % 2 == 1)).count() == 0


def test_first_of_equal_and_nested_prefixes(spark):
    body = "User-agent: *\nAllow: /a/b\nDisallow: /a\nAllow: /a\nDisallow: /\nAllow: /c"
    answers = spark.createDataFrame([("h", 200, body)], "netloc string, http_status int, body string")
    cases = {"http://h/a/b/c": True, "http://h/a": False, "http://h/ab": False, "http://h/c": False, "http://h": False,
             "http://other/a": True, None: True}
    urls = spark.createDataFrame([(u,) for u in cases] * 2, "url string")
    got = robots.robots_allowed(urls, robots.robots_policy(answers, "bot")).collect()
    assert len(got) == 2 * len(cases) and {r.url: r.allowed for r in got} == cases
