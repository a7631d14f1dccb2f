"""Page records read back from exports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..plans.commits import CommitLog
from ..plans.stages import materialize
from ..schema import PAGE_RECORD, TABLE, with_defaults

# The first line of an export in lines ends so, and this is its last line.
_OPENING, _CLOSING = '"pages": [', "]}"

_ENVELOPE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("exported_at", T.StringType()),
        T.StructField("page_count", T.LongType()),
        T.StructField("pages", T.ArrayType(PAGE_RECORD)),
    ]
)


def _checked(df: DataFrame) -> DataFrame:
    """A record without URL is an error, every other field has a default."""
    url = F.coalesce("url", F.raise_error(F.lit("page record without url")).cast("string"))
    return with_defaults(df.withColumn("url", url), "seq")


def read_crawl_json(spark: SparkSession, path: str) -> DataFrame:
    """Records of a one-document export ``{run_id, exported_at, page_count, pages}``.

    ``seq`` is the position in the list. An export with one record per line, in one file or
    in the ordered parts that ``write_crawl_json`` leaves, is read by many tasks; a document
    of any other layout is one task, by nature of the format. A damaged document, a lost
    part or a record that is no JSON is an error.
    """
    lines = spark.read.text(path)
    opening = lines.filter(F.col("value").startswith("{") & F.col("value").endswith(_OPENING))
    heads = opening.limit(2).collect()
    if len(heads) == 1:
        return _checked(_record_rows(lines, json.loads(heads[0]["value"] + "]}")["page_count"]))
    document = spark.read.schema(_ENVELOPE).options(multiLine=True, mode="FAILFAST").json(path)
    pages = document.select(F.posexplode("pages").alias("pos", "page"))
    return _checked(pages.select(F.col("pos").cast("bigint").alias("seq"), "page.*"))


def _record_rows(lines: DataFrame, expected: int) -> DataFrame:
    """Numbered records of a document whose lines are its opening, one record each, its end.

    A line's number is its place in its block of the file and the records of the blocks
    before: nothing is sorted, and one row per block is all that is gathered.
    """
    placed = lines.select(
        "value",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    opening, closing = F.col("value").endswith(_OPENING), F.col("value") == _CLOSING
    blocks = placed.groupBy("file", "block").agg(
        F.min(F.when(~opening & ~closing, F.col("line"))).alias("first"),
        F.count_if(~opening & ~closing).alias("n"),
        F.count_if(opening).alias("openings"),
        F.count_if(closing).alias("closings"),
    )
    blocks = materialize(blocks, "blocks")
    found = blocks.agg(*(F.sum(c).alias(c) for c in ("n", "openings", "closings"))).first()
    if tuple(found) != (expected, 1, 1):
        raise ValueError(
            f"damaged export: {found['n']} records of {expected},"
            f" {found['openings']} openings, {found['closings']} ends"
        )
    before = F.sum("n").over(Window.orderBy("file", "block")) - F.col("n")
    starts = blocks.select("file", "block", "first", before.alias("before"))
    records = placed.filter(~opening & ~closing).join(starts, ["file", "block"])
    record = F.from_json(F.ltrim("value", F.lit(",")), PAGE_RECORD, {"mode": "FAILFAST"})
    return records.select((F.col("before") + F.col("line") - F.col("first")).alias("seq"), record.alias("page")).select(
        "seq", "page.*"
    )


def read_record_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON Lines export, ``seq`` included."""
    schema = T.StructType([T.StructField("seq", T.LongType()), *PAGE_RECORD])
    return _checked(spark.read.schema(schema).json(path))


def _committed(spark: SparkSession, path: str, runs: dict[str, list[str]]) -> DataFrame:
    """Table rows of the given attempts; only their folders are read."""
    attempts = [attempt for found in runs.values() for attempt in found]
    if not attempts:
        return spark.createDataFrame([], TABLE)
    rows = spark.read.schema(TABLE).parquet(path)
    return rows.filter(F.col("run_id").isin(list(runs)) & F.col("attempt").isin(attempts))


def read_run(spark: SparkSession, path: str, run_id: str) -> DataFrame:
    """Records of one run from the page table; only that run's committed files are read.

    The table does not hold the internal/external split, so those lists are empty. A run
    that was never committed has no rows.
    """
    attempts = CommitLog(spark, path).live().get(run_id, [])
    stored = _committed(spark, path, {run_id: attempts}).drop("attempt")
    lists = {
        name: F.from_json(name, PAGE_RECORD[name].dataType)
        for name in ("paragraphs", "headings", "links", "images")
    }
    return with_defaults(stored.withColumns(lists), "seq")


def run_counts(spark: SparkSession, path: str) -> DataFrame:
    """``run_id, page_count`` of the committed runs of the page table."""
    stored = _committed(spark, path, CommitLog(spark, path).live())
    return stored.groupBy("run_id").agg(F.count("*").alias("page_count"))
