"""Token totals kept up to date by signed changes."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import rows_of

KEYS = ("source", "lang", "tokenizer")


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space."""
    return F.size(F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")).cast("bigint")


def character_count(text: Column) -> Column:
    return F.length(text).cast("bigint")


class TokenRollup:
    """Additive totals by source, language and tokenizer version, in one folder.

    Each batch of changes is one set of signed rows, ``doc_id, source, lang, tokenizer,
    docs, tokens``: +1 and the count for an insert, the negative of what earlier batches
    hold for a delete, both for a revision. Totals are sums of rows, so batches can be
    added up in any order. A batch's rows follow from its changes and the batches with
    smaller numbers alone.

    An attempt to commit writes into a folder of its own. When all of it is written, one
    small file named after the batch is moved into ``commits`` and names that folder: this
    move is the commit. An attempt that fails leaves nothing that is read, and a number
    that is committed stays as it is: committing it again does nothing. Which batches are
    committed is read from the folder each time, so a rollup opened on it later goes on
    where the earlier ones stopped.
    """

    SCHEMA = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"

    def __init__(self, spark: SparkSession, folder: str, tokenizers: dict[str, Callable[[Column], Column]]):
        self.spark, self.folder, self.tokenizers = spark, folder.rstrip("/"), tokenizers

    def _path(self, name: str):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def _committed(self) -> dict[int, str]:
        """The folder of each committed batch, by number."""
        path, files = self._path("commits")
        if not files.exists(path):
            return {}
        names = (status.getPath().getName() for status in files.listStatus(path))
        found = (re.fullmatch(r"batch-(-?\d+)@([0-9a-f]+)", name) for name in names)
        return dict(sorted((int(m[1]), f"attempt-{m[2]}") for m in found if m))

    def _publish(self, number: int, attempt: str) -> None:
        (new, files), (done, _) = self._path(f"{attempt}.commit"), self._path("commits")
        files.mkdirs(done)
        files.create(new, False).close()
        name = f"batch-{number}@{attempt.removeprefix('attempt-')}"
        if not files.rename(new, self._path(f"commits/{name}")[0]):
            raise OSError(f"batch {number} could not be committed")

    def _rows(self, attempts: list[str]) -> DataFrame:
        if not attempts:
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(
            *(f"{self.folder}/{attempt}" for attempt in attempts)
        )

    def commit(self, number: int, changes: DataFrame) -> bool:
        """Record batch ``number`` of ``changes (kind, doc_id, source, lang, text)``.

        Returns whether it was recorded now: a committed number is left as it is. One
        writer at a time: of two that commit one number at the same moment both may end.

        ``kind`` is insert, delete or revise. Null texts count as empty; null sources and
        languages are groups of their own. Deleting or revising what is not there takes
        nothing away. Repeated rows are changes each; inserts are not checked for being
        there already. Rows with a null id can be inserted only.
        """
        done = self._committed()
        if number in done:
            return False
        rows = rows_of(changes, "kind", "doc_id", "source", "lang", "text")
        counts = F.array(
            *(
                F.struct(F.lit(name).alias("tokenizer"), count(F.coalesce("text", F.lit(""))).alias("tokens"))
                for name, count in self.tokenizers.items()
            )
        )
        added = rows.filter("kind IN ('insert', 'revise')").select("doc_id", "source", "lang", F.inline(counts))
        added = added.select("doc_id", *KEYS, F.lit(1).cast("long").alias("docs"), "tokens")
        gone = rows.filter("kind IN ('delete', 'revise')").select("doc_id").distinct()
        earlier = self._rows([attempt for n, attempt in done.items() if n < number])
        taken = earlier.join(gone, "doc_id").groupBy("doc_id", *KEYS).agg(
            (-F.sum("docs")).alias("docs"), (-F.sum("tokens")).alias("tokens")
        )
        taken = taken.filter("docs <> 0 OR tokens <> 0").select("doc_id", *KEYS, "docs", "tokens")
        attempt = f"attempt-{uuid.uuid4().hex}"
        added.union(taken).write.parquet(f"{self.folder}/{attempt}")
        self._publish(number, attempt)
        return True

    def totals(self) -> DataFrame:
        """``source, lang, tokenizer, docs, tokens`` over all committed batches."""
        sums = self._rows(list(self._committed().values())).groupBy(*KEYS).agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        return sums.filter("docs <> 0 OR tokens <> 0")
