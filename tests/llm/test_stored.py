"""What a stored table leaves behind."""

import time

from pyspark.sql import functions as F

from pageloom.llm.stages import _CLEANUP, stored


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(n).getName() for n in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_stored_leaves_no_shuffle_files(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.sum("id").alias("s"))
    before = _shuffle_files(spark)
    setting = spark.conf.get(_CLEANUP, None)
    kept = stored(rows, "sums")
    for _ in range(50):
        if not _shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(_CLEANUP, None) == setting
    # The table reads on, and so does what it was made of.
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, rows.collect()))
    assert kept.join(rows, ["k", "s"]).count() == 10
