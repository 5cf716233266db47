"""Path checks through the file system Spark reads from."""

import re

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def plain_path(spark: SparkSession, path: str) -> str:
    """Absolute form of a path as it starts the paths of the files below it."""
    fs, jvm_path = _file_system(spark, path)
    return re.sub(r"^file:/+", "/", fs.makeQualified(jvm_path).toString()).rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _file_system(spark, path)
    return fs.exists(jvm_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; empty if it does not exist."""
    fs, jvm_path = _file_system(spark, path)
    if not fs.exists(jvm_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jvm_path))
