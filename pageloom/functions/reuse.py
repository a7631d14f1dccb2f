"""Column expressions that are built once and used in many plans."""

from __future__ import annotations

from functools import lru_cache, wraps

from pyspark.sql import SparkSession


def per_application(build):
    """Keep what ``build`` returns for each set of arguments and Spark application.

    Columns name what they read and are not tied to a DataFrame. Building a large one
    takes a call into the JVM per node, longer than Spark needs to plan it.
    """

    @lru_cache(maxsize=64)
    def stored(application, *args):
        return build(*args)

    @wraps(build)
    def get(*args):
        return stored(SparkSession.active().sparkContext.applicationId, *args)

    return get
