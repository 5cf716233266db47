"""Tables bucketed by a key in a folder, so that joins and aggregates on the key need no shuffle of them.

The folder is described to Spark as an external table of the session; every append adds files to
the buckets of its rows. The number of buckets is part of the folder's name, so a reader can't get it wrong.
"""

from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from goldquarry.sources.paths import child_names, plain_path


def _folder(path: str, buckets: int) -> str:
    return f"{path.rstrip('/')}/by_{buckets}"


def _table(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> str:
    folder = plain_path(spark, _folder(path, buckets))
    name = f"buckets_{md5(f'{folder}|{key}|{schema.simpleString()}'.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{folder}'"
    )
    return name


def append_buckets(df: DataFrame, path: str, schema: StructType, key: str, buckets: int) -> None:
    """Add rows to a bucketed folder; one shuffle by the key, so that a bucket gets one file."""
    name = _table(df.sparkSession, path, schema, key, buckets)
    rows = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    rows.repartition(buckets, key).write.insertInto(name)


def read_buckets(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame | None:
    """The rows of a bucketed folder; None if nothing was added yet."""
    if not child_names(spark, _folder(path, buckets)):
        return None
    name = _table(spark, path, schema, key, buckets)
    spark.catalog.refreshTable(name)
    return spark.table(name)
