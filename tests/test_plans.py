"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from pageloom.operators import search
from pageloom.operators.pages import parse_pages
from pageloom.plans.stages import checkpoint_dir, materialize
from pageloom.sources import fetches

FOLDER = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_parsing_needs_no_shuffle_and_no_python(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    plan = physical(parse_pages(fetches.fetches_from_pages(pages)))
    assert "Exchange" not in plan and "Python" not in plan


def test_scan_reads_only_what_is_needed(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = physical(search.keyword_frequency(fetches.records_from_documents(documents)))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_frequency_aggregates_by_hash_before_the_shuffle(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plan = physical(search.keyword_frequency(fetches.records_from_documents(documents)))
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2


@pytest.mark.parametrize("rows", [0, 100_000])
def test_batch_search_limits_ranks_before_the_last_shuffle(spark, monkeypatch, no_broadcast, rows):
    monkeypatch.setattr(search, "BROADCAST_ROWS", rows)
    records = fetches.records_from_documents(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    keywords = spark.createDataFrame([("the",), ("of",)], "keyword string")
    plan = physical(search.keyword_search_batch(records, keywords, 5))
    # Read from the top: final limit, exchange by keyword, limit of a part.
    last = plan.index("WindowGroupLimit")
    exchange = plan.index("Exchange hashpartitioning(keyword#", last)
    assert plan.index("WindowGroupLimit", exchange) > exchange


def test_registered_queries_have_sql(spark):
    optional = re.compile(r"op\d+_|pipeline$")
    own = {name for name in registry.queries() if not optional.match(name)}
    checked = {name for name in registry.oracle_sql() if not optional.match(name)}
    assert own == checked


def test_no_nested_loops(spark, no_broadcast):
    for name in ("frontier_next", "host_delays", "robots_verdicts", "crawl_pages_stats"):
        plan = physical(registry.queries()[name](spark, FOLDER))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_stages_use_the_configured_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        assert checkpoint_dir(spark) == folder
    df = materialize(spark.range(3).select(F.col("id") * 2), "numbers")
    assert df.count() == 3 and all(checkpoint_dir(spark) in f for f in df.inputFiles())


def test_hot_keys_give_whole_results(spark, no_broadcast):
    """A third of all links point at one URL, a third of all words are one word."""
    from pageloom.operators.frontier import dedupe_frontier, link_key

    links = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "https://h/hot")
        .otherwise(F.concat(F.lit("https://h/"), "id")).alias("url"),
        link_key(F.lit(30_000) - F.col("id"), F.lit(0)).alias("key"),
    )
    first = dedupe_frontier(links)
    assert first.count() == 20_001
    assert first.filter("url = 'https://h/hot'").first()["key"] == 3 * 2**31
    assert "SortAggregate" not in physical(first)


def test_only_hot_keys_are_split(spark, monkeypatch, no_broadcast):
    from pageloom.plans import stages

    left = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("key"), "id"
    )
    right = left.select("key").distinct().withColumn("size", F.length("key"))
    monkeypatch.setattr(stages, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(stages, "HOT_ROWS", 10_000)
    whole = stages.split_join(left, right, "key", ["id"])
    assert "Generate" not in physical(whole) and "_salt" not in physical(whole)
    monkeypatch.setattr(stages, "HOT_ROWS", 1_000)
    split = stages.split_join(left, right, "key", ["id"])
    assert split.count() == 9_000 and split.agg(F.sum("size")).first()[0] == whole.agg(F.sum("size")).first()[0]
    # The hot key's row is copied three times, all others once.
    hot = left.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1000")
    assert [tuple(r) for r in hot.collect()] == [("hot", 3000)]
    assert stages.split_join(left, right, "key", ["id"], counts=hot).count() == 9_000


def test_dropping_stages(spark):
    from pageloom.plans.stages import stage_path

    df = materialize(spark.range(3), "gone")
    assert df.count() == 3 and stage_path(spark, "x") != stage_path(spark, "x")
