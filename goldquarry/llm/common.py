"""Small helpers shared by the operators: stored stages, row keys and checked broadcasts."""

import itertools
import re

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from goldquarry.sources.stages import drop_stage, store_stage, write_stage

# Rows up to which a side of known narrow rows is broadcast; beyond, it is joined by a shuffle.
BROADCAST_ROWS = 200_000


# Rows of text that go to a Python worker at once, and Spark's own number.
BATCH_ROWS, SPARK_BATCH_ROWS = 1000, "10000"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python in batches of few rows, unless the session sets a number of its own.

    Ten thousand texts at a time, in the buffers of both sides, are more than a small executor has.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == SPARK_BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back, so nothing before it runs twice."""
    return store_stage(df, re.sub(r"\W", "-", name))


def freed_stage(df: DataFrame, name: str) -> DataFrame:
    """A stored stage; the shuffles that led to it, which nothing else reads, leave the disk at once.

    Otherwise they stay until the driver happens to collect its garbage.
    """
    return freed_folder(df, name)[0]


def freed_folder(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """`freed_stage`, and its folder, which goes by `drop_folders` when nothing reads it any more."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        folder = write_stage(df, re.sub(r"\W", "-", name))
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(folder), folder


def drop_folders(spark: SparkSession, folders) -> None:
    for folder in folders:
        drop_stage(spark, folder)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table with a broadcast hint if a count proves it small; unchanged otherwise."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def row_keys():
    """Numbers that differ between all rows of a job, the same when a task runs again."""
    return itertools.count(TaskContext.get().partitionId() << 40)


def parts_for(df: DataFrame, size: int, size_per_part: int) -> int:
    """Number of parts of at most about `size_per_part`, and at least as many as a shuffle has."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // size_per_part))
