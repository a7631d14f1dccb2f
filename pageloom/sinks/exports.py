"""Writers. Every format is written by all tasks in parallel, in visit order."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from ..operators.pages import page_metrics
from ..plans.commits import CommitLog, exists, publish_folder
from ..plans.stages import materialize
from ..schema import RECORD_FIELDS

# --- Fixed values ---------------------------------------------------------------
SITEMAP_NAMESPACE = "http://www.sitemaps.org/schemas/sitemap/0.9"
CSV_COLUMNS = [
    "url", "status_code", "title", "meta_description", "meta_keywords",
    "depth", "word_count", "num_headings", "num_paragraphs",
    "num_links", "num_internal_links", "num_external_links",
    "num_images", "fetched_at", "error",
]
FORMATS = ("json", "csv", "sqlite")
RUN_ID_FORMAT = "%Y%m%d_%H%M%S"
_TABLE_JSON = ("paragraphs", "headings", "links", "images")
_TABLE_COLUMNS = [
    "seq", "url", "status_code", "title", "meta_description", "meta_keywords",
    "depth", "word_count", "paragraphs", "headings", "links", "images",
    "fetched_at", "error",
]
# --------------------------------------------------------------------------------


def _now() -> datetime:
    return datetime.now(timezone.utc)


def write_record_lines(records: DataFrame, path: str) -> None:
    """JSON Lines with ``seq``: splittable, and the form for large runs."""
    (
        records.select("seq", *RECORD_FIELDS)
        .write.mode("overwrite")
        .option("ignoreNullFields", False)
        .json(path)
    )


def write_manifest(records: DataFrame, path: str, run_id: str) -> None:
    """One row ``run_id, exported_at, page_count`` beside the lines."""
    manifest = records.agg(F.count("*").alias("page_count")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(_now().isoformat()).alias("exported_at"),
        "page_count",
    )
    manifest.write.mode("overwrite").json(path)


def write_crawl_json(records: DataFrame, path: str, run_id: str, parts: int | None = None) -> None:
    """The one-document form, as ordered text parts (``parts`` of them, else as Spark decides).

    ``cat part-*`` yields ``{run_id, exported_at, page_count, pages: […]}``. Opening,
    records and closing are rows of one range-sorted table, so no task or driver holds
    more than its share of the records. The records are computed once, as stored text:
    counting, sampling for the sort and the sort read that.
    """
    spark = records.sparkSession
    text = F.to_json(F.struct(*RECORD_FIELDS), {"ignoreNullFields": "false"})
    stored = materialize(
        records.select(F.col("seq").cast("bigint").alias("seq"), text.alias("value")), "document"
    )
    size = stored.agg(F.count("*").alias("n"), F.min("seq").alias("first")).first()
    head = json.dumps(
        {"run_id": run_id, "exported_at": _now().isoformat(), "page_count": size["n"]},
        ensure_ascii=False,
    )
    comma = F.when(F.col("seq") == F.lit(size["first"]), "").otherwise(",")
    body = stored.select(F.lit(1).alias("part"), "seq", F.concat(comma, "value").alias("value"))
    frame = spark.createDataFrame(
        [(0, 0, head[:-1] + ', "pages": ['), (2, 0, "]}")], "part int, seq bigint, value string"
    )
    whole = frame.unionByName(body)
    if parts:
        whole = whole.repartitionByRange(parts, "part", "seq").sortWithinPartitions("part", "seq")
    else:
        whole = whole.orderBy("part", "seq")
    whole.select("value").write.mode("overwrite").text(path)


def csv_rows(records: DataFrame) -> DataFrame:
    """The CSV columns in visit order; the sort samples and reads stored counts, not pages."""
    return materialize(page_metrics(records), "metrics").orderBy("seq").select(*CSV_COLUMNS)


def write_csv(records: DataFrame, path: str) -> None:
    """Header, fixed columns, doubled quotes, null as empty; lines end in LF.

    Only the flat counts are sorted, not the page contents.
    """
    (
        csv_rows(records)
        .write.mode("overwrite")
        .options(header=True, escape='"', emptyValue="", nullValue="")
        .csv(path)
    )


def table_rows(records: DataFrame, run_id: str) -> DataFrame:
    """Records as stored in the page table: lists and headings as JSON text."""
    texts = {name: F.to_json(name) for name in _TABLE_JSON}
    return (
        records.withColumns(texts | {"seq": F.col("seq").cast("bigint")})
        .select(*_TABLE_COLUMNS)
        .withColumn("run_id", F.lit(run_id))
    )


def append_table(
    records: DataFrame,
    path: str,
    run_id: str,
    replace_run: bool = False,
    once: bool = False,
) -> bool:
    """Append a run to the page table, created if absent and partitioned by run and attempt.

    The files count from the moment their commit record is there: an attempt that breaks
    leaves nothing that :func:`~pageloom.sources.records.read_run` reads. Every call adds
    its rows, unless ``replace_run`` (they take the place of the run's earlier rows, which
    stay until then) or ``once`` (a committed run is left as it is). Returns whether rows
    were written. Files are sorted by URL, so their min/max statistics serve look-ups.
    """
    log = CommitLog(records.sparkSession, path)
    if once and not replace_run and run_id in log.live():
        return False
    attempt = uuid.uuid4().hex
    rows = table_rows(records, run_id).withColumn("attempt", F.lit(attempt))
    writer = rows.sortWithinPartitions("url").write.mode("append")
    writer.partitionBy("run_id", "attempt").parquet(path)
    log.publish(run_id, attempt, replace_run)
    return True


def sitemap_rows(records: DataFrame) -> DataFrame:
    """``loc, lastmod`` of the successful records, with ``seq`` for the order."""
    date = F.substring_index("fetched_at", "T", 1)
    return records.filter(F.col("error").isNull()).select(
        "seq",
        F.col("url").alias("loc"),
        F.when(F.col("fetched_at") != "", date).alias("lastmod"),
    )


def write_sitemap(records: DataFrame, path: str) -> None:
    """XML sitemap; each part file is a sitemap of its own. The sort reads stored rows."""
    (
        materialize(sitemap_rows(records), "sitemap")
        .orderBy("seq")
        .select("loc", "lastmod")
        .write.mode("overwrite")
        .format("xml")
        .option("rootTag", f'urlset xmlns="{SITEMAP_NAMESPACE}"')
        .option("rowTag", "url")
        .option("declaration", 'version="1.0" encoding="UTF-8"')
        .save(path)
    )


def export(
    records: DataFrame,
    folder: str,
    formats: Iterable[str] = FORMATS,
    run_id: str | None = None,
    one_document: bool = False,
    replace: bool = False,
) -> dict[str, str]:
    """Write the known ``formats`` and return format → path; others are ignored.

    The records are computed once and read back by each writer. JSON is written as
    lines with a manifest, or as one document in parts with ``one_document``.

    A run counts once however often it is exported: each format is written to a folder of
    its own attempt and published in one step (files by moving the finished folder, table
    rows by a commit record), and a format that is published is left as it is unless
    ``replace``. So an export that broke can be repeated; it does what is missing.
    """
    spark = records.sparkSession
    run_id = run_id or _now().strftime(RUN_ID_FORMAT)
    wanted = [f for f in FORMATS if f in set(formats)]
    folder = folder.rstrip("/")
    paths = {
        "json": f"{folder}/crawl_{run_id}.json",
        "csv": f"{folder}/crawl_{run_id}.csv",
        "sqlite": f"{folder}/pages",
    }
    if replace:
        open_formats = wanted
    else:
        done = {f for f in wanted if f != "sqlite" and exists(spark, paths[f])}
        if "sqlite" in wanted and run_id in CommitLog(spark, paths["sqlite"]).live():
            done.add("sqlite")
        open_formats = [f for f in wanted if f not in done]
    lines = "json" in open_formats and not one_document
    if len(open_formats) > 1 or lines:
        records = materialize(records, "export")
    staged = f"{folder}/_attempts/{uuid.uuid4().hex}"
    if "json" in open_formats:
        if lines:
            write_record_lines(records, f"{staged}/json")
            write_manifest(records, f"{staged}/manifest", run_id)
            publish_folder(spark, f"{staged}/manifest", f"{folder}/crawl_{run_id}.manifest")
        else:
            write_crawl_json(records, f"{staged}/json", run_id)
        publish_folder(spark, f"{staged}/json", paths["json"])
    if "csv" in open_formats:
        write_csv(records, f"{staged}/csv")
        publish_folder(spark, f"{staged}/csv", paths["csv"])
    if "sqlite" in open_formats:
        append_table(records, paths["sqlite"], run_id, replace_run=replace, once=True)
    return {f: paths[f] for f in wanted}
