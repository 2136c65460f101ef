"""Intermediate tables in the shared folder.

Iterated joins need the real size of what they have reached. A checkpoint keeps the estimate of
its plan, which multiplies with every join until it is too long a number to handle; a table that
is read back has the size of its files.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidegate.session import scratch_path

_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def unused(df: DataFrame, *names: str):
    """Column names that start like `names` and that `df` doesn't have: one, or a list."""
    there, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in there:
            name += "_"
        there.add(name.lower())
        out.append(name)
    return out[0] if len(out) == 1 else out


def stored(df: DataFrame, label: str = "table") -> DataFrame:
    """The rows written as Parquet below the shared folder and read back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of each job go when it ends. Otherwise they stay until the driver
    happens to collect its garbage, so that those of many jobs add up."""
    before = spark.conf.get(_FREED, None)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        if before:
            spark.conf.set(_FREED, before)
        else:
            spark.conf.unset(_FREED)
