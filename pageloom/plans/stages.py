"""Cutting a long plan into stages that survive lost executors."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows of a few short columns that are safe to hold in every executor.
BROADCAST_ROWS = 100_000
# Rows of one key that a task takes before the key is split.
HOT_ROWS = 250_000
_CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where unset, in the warehouse."""
    folder = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    return folder.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/pageloom/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path below the application's stage folder."""
    return f"{_application_folder(spark)}/{uuid.uuid4().hex}/{name}"


def drop_stages(spark: SparkSession) -> None:
    """Delete all stage files of this application; results read from them are lost."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the files.

    The files end the lineage and pin everything that is not deterministic. Reading
    them back also gives Catalyst exact sizes, so it broadcasts what is really small.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class BucketedTable:
    """Stored rows in buckets by one column, in parts that are appended one by one.

    Joins and aggregations on the column read the buckets where they lie: no exchange.
    The table is external, below the stage folder; its entry in the catalog holds for the
    session (with a metastore: until it is dropped).
    """

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int | None = None):
        self.spark, self.key = spark, key
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"pageloom_{name}_{uuid.uuid4().hex}"
        self.path = stage_path(spark, name)
        self.parts = 0

    def append(self, df: DataFrame) -> int:
        """Write ``df`` as the next part, one file per bucket; returns the part's number."""
        number = self.parts
        rows = df.withColumn("part", F.lit(number)).repartition(self.buckets, self.key)
        writer = rows.write.mode("append").format("parquet").option("path", self.path)
        writer.partitionBy("part").bucketBy(self.buckets, self.key).saveAsTable(self.name)
        self.parts += 1
        return number

    def rows(self, part: int | None = None) -> DataFrame:
        """All rows written so far, or those of one part."""
        table = self.spark.table(self.name)
        return (table if part is None else table.filter(F.col("part") == part)).drop("part")


def fits(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def split_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: list[str],
    how: str = "left",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join on ``key`` when very many rows of ``left`` may share one value of it.

    ``right`` has one narrow row per key and is broadcast if it has few rows. Otherwise
    the keys of ``left`` are counted (``counts(key, n)`` if the caller has them) and only
    those with more than ``HOT_ROWS`` rows are split: their rows are spread by a hash of
    ``spread`` and their one row of ``right`` is copied as often as they need. All other
    rows join as they are.
    """
    if fits(right, BROADCAST_ROWS):
        return left.join(F.broadcast(right), key, how)
    if counts is None:
        counts = left.groupBy(key).agg(F.count("*").alias("n"))
    hot = counts.filter(F.col("n") > HOT_ROWS).select(
        key, F.ceil(F.col("n") / HOT_ROWS).cast("int").alias("_parts")
    )
    hot = materialize(hot.dropna(), "hot-keys")
    if hot.isEmpty():
        return left.join(right, key, how)
    # At most one row per HOT_ROWS rows of the left side; its file tells Spark its size.
    chosen = left.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.hash(*spread), F.coalesce("_parts", F.lit(1)))
    )
    copies = right.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    )
    return chosen.drop("_parts").join(copies.drop("_parts"), [key, "_salt"], how).drop("_salt")


def sorted_rows(df: DataFrame, *order: Column | str) -> tuple[DataFrame, Column]:
    """Rows range-sorted and stored, with their place in ``_id``, and the column of the part."""
    spread = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    return materialize(spread, "sorted"), F.shiftright("_id", 33)


def row_index(sizes: dict[int, int]) -> tuple[Column, int]:
    """The running number of :func:`sorted_rows`' rows, and how many there are.

    ``sizes`` are the rows of each part; one number per part is all the driver sees.
    """
    offsets, total = [], 0
    for number in range(max(sizes, default=-1) + 1):
        offsets.append(total)
        total += sizes.get(number, 0)
    table = F.from_json(F.lit(json.dumps(offsets)), "array<bigint>")
    offset = F.get(table, F.shiftright("_id", 33).cast("int"))
    return offset + F.col("_id").bitwiseAND(F.lit(2**33 - 1)), total


def with_row_index(
    df: DataFrame, *order: Column | str, name: str = "idx"
) -> tuple[DataFrame, int]:
    """Number the rows 0, 1, 2… in ``order``; returns them and their count.

    There is no one-partition window: range-sorted rows are written with their place
    inside the partition, and the sizes of the partitions become the offsets.
    """
    saved, part = sorted_rows(df, *order)
    sizes = saved.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    index, total = row_index({row["part"]: row["n"] for row in sizes})
    return saved.withColumn(name, index).drop("_id"), total
