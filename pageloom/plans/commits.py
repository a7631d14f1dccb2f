"""Which attempts at writing a run count."""

from __future__ import annotations

import re
from urllib.parse import quote, unquote

from pyspark.sql import SparkSession

_RECORD = re.compile(r"(\d+)\.([0-9a-f]+)\.(append|replace)\.(.*)")


def file_system(spark: SparkSession, path: str):
    """The Hadoop path of ``path`` and its file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


class CommitLog:
    """Commit records of a table whose files lie in one folder per attempt.

    A record is one empty file ``number.attempt.kind.run`` below ``_commits``: creating it
    is the only step that makes an attempt's files count, so what a broken attempt leaves is
    never read. A record of kind ``replace`` ends the earlier attempts of its run. There is
    one record per export, and only their names come to the driver. One writer at a time
    decides the order of two replacements of the same run; appends may run side by side.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/_commits"

    def _records(self) -> list[tuple[int, str, str, str]]:
        path, files = file_system(self.spark, self.folder)
        if not files.exists(path):
            return []
        names = (status.getPath().getName() for status in files.listStatus(path))
        found = (_RECORD.fullmatch(name) for name in names)
        return sorted((int(m[1]), m[2], m[3], unquote(m[4])) for m in found if m)

    def live(self) -> dict[str, list[str]]:
        """The attempts that count, by run."""
        runs: dict[str, list[str]] = {}
        for _, attempt, kind, run in self._records():
            runs[run] = [*(runs.get(run, []) if kind == "append" else []), attempt]
        return runs

    def publish(self, run_id: str, attempt: str, replace: bool = False) -> None:
        records = self._records()
        number = records[-1][0] + 1 if records else 0
        kind = "replace" if replace else "append"
        name = f"{number:08d}.{attempt}.{kind}.{quote(run_id, safe='')}"
        path, files = file_system(self.spark, f"{self.folder}/{name}")
        files.create(path, False).close()


def publish_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Move the finished folder ``staged`` to ``path``, in place of what is there."""
    source, files = file_system(spark, staged)
    target, _ = file_system(spark, path)
    files.mkdirs(target.getParent())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{staged} could not be moved to {path}")


def exists(spark: SparkSession, path: str) -> bool:
    found, files = file_system(spark, path)
    return files.exists(found)
