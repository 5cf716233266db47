"""Item tables derived from the driver's documents, labels and embeddings tables.

A document stands for a frame, its label row for the annotation sidecar and an embedding, read as
an 8 x 8 grid of grey levels, for its picture. All columns are derived; no row is left out.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.geometry import box, visibility_bucket
from goldquarry.functions.labels import coerce_labels, curation_status
from goldquarry.operators.joins import attach
from goldquarry.operators.pixels import grid_stats, with_box_ratio
from goldquarry.operators.quality import quality_filter
from goldquarry.schema import BOXES

GRID = 8
OUT_DIR = "/data/augmented"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values, step: int):
    spot = F.pmod(F.col("doc_id") * step, F.lit(len(values))).cast("int")
    return F.get(F.array(*map(F.lit, values)), spot)


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents LEFT JOIN labels in the shape of curated item rows (status and stats excepted)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    doc = F.col("doc_id")
    base = F.concat(F.lit("/data/"), F.col("source"), F.lit("/"), doc.cast("string"))
    boxes = F.transform(
        F.sequence(F.lit(1), F.pmod(doc, F.lit(3)).cast("int")),
        lambda i: box(i, i, i + F.pmod(F.col("n_chars"), F.lit(20)), i + F.pmod(doc, F.lit(11))),
    )
    kind = F.pmod(doc, F.lit(5))
    strings = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    return (
        docs.join(labels, "doc_id", "left")
        .select(
            doc.cast("string").alias("image_id"),
            F.concat(base, F.lit(".jpg")).alias("image_path"),
            (100 + F.pmod(doc, F.lit(50))).cast("int").alias("width"),
            (80 + F.pmod(doc, F.lit(40))).cast("int").alias("height"),
            (F.col("quality") == 1).alias("drone_present"),
            F.when(F.pmod(doc, F.lit(3)) == 0, F.array().cast(BOXES)).otherwise(boxes).alias("bbox"),
            F.pmod(doc, F.lit(3)).cast("int").alias("box_count"),
            F.col("source").alias("source_split"),
            F.when(F.col("quality").isNotNull(), F.concat(base, F.lit(".xml"))).alias("xml_path"),
            F.lit("real").alias("augmentation_type"),
            F.lit(None).cast("string").alias("source_image_id"),
            F.lit(False).alias("is_synthetic"),
            F.col("toxic"),
            F.col("n_chars"),
            F.when(F.col("lang") == "en", "sky")
            .when(F.col("lang") == "fr", "trees")
            .when(F.col("lang") == "de", "building")
            .otherwise("cluttered")
            .alias("background"),
            _pick(fv.LIGHTINGS, 7).alias("lighting"),
            _pick(fv.BLUR_BUCKETS, 5).alias("blur_bucket"),
            F.when(kind == 0, strings())
            .when(kind == 2, strings("none"))
            .when(kind == 3, strings("bird"))
            .when(kind == 4, strings("aircraft", "bird"))
            .alias("possible_confusers"),
            _pick(fv.CAMERA_ANGLES, 11).alias("camera_angle"),
            _pick(fv.DEPTH_RANGES, 13).alias("depth_range"),
        )
        .withColumn(
            "drone_visibility",
            visibility_bucket(F.col("drone_present"), F.col("bbox"), F.col("width"), F.col("height")),
        )
    )


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(image_id, grid): embeddings as grey levels."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("image_id"),
        F.transform("embedding", lambda v: F.lit(127.5) + F.lit(240.0) * v.cast("double")).alias("grid"),
    )


def grid_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_stats(grids(spark, sf_dir), F.col("grid"), GRID, GRID).drop("grid")


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with clean confusers, status and statistics."""
    items = frames(spark, sf_dir).withColumn(
        "possible_confusers", coerce_labels(F.col("possible_confusers"))
    )
    items = items.withColumn("curation_status", curation_status(F.col("possible_confusers")))
    return with_box_ratio(attach(items, grid_statistics(spark, sf_dir), "image_id"))


def golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_filter(curated(spark, sf_dir))
