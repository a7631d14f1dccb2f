"""Page records from fetches as they are captured."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.fetchlog import classify_fetch
from ..operators.pages import parse_pages
from ..schema import FETCH


def stream_records(
    spark: SparkSession, path: str, strict_status: bool = True
) -> DataFrame:
    """Records of every fetch file that arrives in ``path``; row-local, no state."""
    arriving = spark.readStream.schema(FETCH).parquet(path)
    return parse_pages(classify_fetch(arriving, strict_status))


def append_records(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there to a Parquet folder, each file once, then stop."""
    return (
        records.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
