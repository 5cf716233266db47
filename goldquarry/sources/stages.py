"""Stored intermediate tables on the storage the cluster shares."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir.

    A session on one machine without that setting gets a new temporary folder, as in tests; on a
    cluster the setting is required, because executors share no other folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="stages-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def write_stage(df: DataFrame, name: str) -> str:
    """Write a table to a new folder below the stage root; its path."""
    path = f"{stage_root(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def store_stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table and return the stored one.

    Used where a recomputation would repeat costly calls: after this, a lost executor or a
    second use of the table reads the files instead.
    """
    path = write_stage(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a stage that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
