"""JSON-lines, CSV and Parquet artifacts and the catalogue of named ones."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from goldquarry import fixed_values as fv
from goldquarry.operators.coverage import crosstab_tables
from goldquarry.schema import ARTIFACT_SCHEMAS
from goldquarry.sources.paths import child_names, path_exists

BOOL_COLUMNS = ("drone_present", "is_synthetic")


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON record per line; nulls are written, so every record has all its fields."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, bool_cols=BOOL_COLUMNS) -> DataFrame:
    """Records with an explicit schema, blank lines skipped.

    The named boolean columns may be stored as strings: "true" in any case is true and
    everything else, null included, false.
    """
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in bool_cols else f.dataType)
            for f in schema.fields
        ]
    )
    df = spark.read.schema(as_text).json(path)
    flags = {
        f.name: F.coalesce(F.lower(f.name) == "true", F.lit(False))
        for f in schema.fields
        if f.name in bool_cols
    }
    return df.withColumns(flags) if flags else df


def export_coverage(coverage: DataFrame, gaps: DataFrame, crosstabs: DataFrame, path: str) -> None:
    """CSV files: one folder per dimension, one for the gaps, and the cross-tabs twice.

    `coverage_crosstab` holds all cells in long form, `coverage_crosstab_<tab>` each cross-tab as a table with a row label
    column and an "All" row and column.
    """
    write = lambda df: df.write.mode("overwrite").option("header", "true")
    write(coverage.repartition("dimension")).partitionBy("dimension").csv(f"{path}/coverage")
    write(gaps.coalesce(1)).csv(f"{path}/coverage_gaps")
    write(crosstabs.repartition("tab")).partitionBy("tab").csv(f"{path}/coverage_crosstab")
    for tab, table in crosstab_tables(crosstabs).items():
        write(table.coalesce(1)).csv(f"{path}/coverage_crosstab_{tab}")


def write_run(results: DataFrame, summary: DataFrame, path: str, run_label: str | None = None) -> None:
    """Results and summary per run; runs with other labels stay untouched.

    The label is `run_label` or else the model name, so that one write stores a whole sweep.
    """
    label = F.col("model") if run_label is None else F.lit(run_label)
    for df, name in ((results, "retrieval_results"), (summary, "retrieval_eval_summary")):
        (
            df.withColumn("run", label)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("ignoreNullFields", "false")
            .partitionBy("run")
            .json(f"{path}/{name}")
        )


def artifact_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{fv.ARTIFACT_FILES[name]}"


def write_dataset(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> None:
    """Store a new version of a named artifact as Parquet (the primary form) or JSON lines.

    Earlier versions stay, so a job may read an artifact while it writes the next version, and
    a write that fails half-way leaves the last complete version in place.
    """
    path = artifact_path(root, name)
    taken = [int(v.partition(".")[0]) for v in child_names(df.sparkSession, path)]
    version = f"{path}/{max(taken, default=0) + 1:06d}"
    if fmt == "json":
        write_jsonl(df, f"{version}.jsonl")
    else:
        df.write.parquet(f"{version}.parquet")


def load_dataset(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The last complete version of a named artifact; None if there is none."""
    path = artifact_path(root, name)
    for version in reversed(child_names(spark, path)):
        if not path_exists(spark, f"{path}/{version}/_SUCCESS"):
            continue
        if version.endswith(".jsonl"):
            return read_jsonl(spark, f"{path}/{version}", ARTIFACT_SCHEMAS[name])
        return spark.read.schema(ARTIFACT_SCHEMAS[name]).parquet(f"{path}/{version}")
    return None


def catalogue(spark: SparkSession, root: str) -> DataFrame:
    """(name, available, rows) of all named artifacts."""
    table = None
    for name in fv.ARTIFACT_FILES:
        df = load_dataset(spark, root, name)
        if df is None:
            row = spark.range(1).select(
                F.lit(name).alias("name"), F.lit(False).alias("available"), F.lit(0).cast("long").alias("rows")
            )
        else:
            row = df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("name"), F.lit(True).alias("available"), "rows"
            )
        table = row if table is None else table.unionByName(row)
    return table
