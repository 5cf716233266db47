"""Assembly of item rows from image listings and annotation sidecars."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldquarry import fixed_values as fv
from goldquarry.schema import BASE, BOXES, QUARANTINE
from goldquarry.sources.annotations import positive_prefix_test, read_annotations
from goldquarry.sources.images import image_dims, list_images
from goldquarry.sources.paths import path_exists


def assemble_items(
    images: DataFrame,
    annotations: DataFrame,
    split: str | None = None,
    dims: DataFrame | None = None,
    positive_prefix: str | None = fv.POSITIVE_ID_PREFIX,
) -> DataFrame:
    """Base records: images LEFT JOIN annotations by id.

    The annotated size wins over the size in the image header. An item is positive if it has a
    box or its id starts with the prefix. `annotations` holds one row per id. Items whose annotation
    has an `xml_error`, or whose image is not `readable` by `dims`, are left out: `quarantined` has them.
    """
    if "xml_error" in annotations.columns:
        broken = annotations.where("xml_error IS NOT NULL").select("image_id")
        images = images.join(broken, "image_id", "left_anti")
    sidecar = annotations.select(
        "image_id",
        "xml_path",
        F.col("width").alias("_aw"),
        F.col("height").alias("_ah"),
        F.col("bbox").alias("_boxes"),
    )
    rows = images.join(sidecar, "image_id", "left")
    if dims is not None:
        header = dims.select("image_path", F.col("width").alias("_hw"), F.col("height").alias("_hh"))
        unreadable = dims.where("NOT readable").select("image_path").distinct()
        rows = rows.join(header, "image_path", "left").join(unreadable, "image_path", "left_anti")
    else:
        rows = rows.withColumns({"_hw": F.lit(None).cast("int"), "_hh": F.lit(None).cast("int")})
    boxes = F.coalesce("_boxes", F.array().cast(BOXES))
    values = {
        "image_id": F.col("image_id"),
        "image_path": F.col("image_path"),
        "width": F.coalesce("_aw", "_hw", F.lit(0)),
        "height": F.coalesce("_ah", "_hh", F.lit(0)),
        "drone_present": (F.size(boxes) > 0) | positive_prefix_test(F.col("image_id"), positive_prefix),
        "bbox": boxes,
        "box_count": F.size(boxes),
        "source_split": F.lit(split) if split is not None else F.col("source_split"),
        "xml_path": F.col("xml_path"),
        "augmentation_type": F.lit("real"),
        "source_image_id": F.lit(None),
        "is_synthetic": F.lit(False),
    }
    return rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in BASE.fields])


def load_split(spark: SparkSession, path: str, split: str, header_sizes: bool = True) -> DataFrame:
    """Base records of one folder.

    Sizes of images without a sidecar come from the image headers, which takes a pass over the
    images; without `header_sizes` they are 0.
    """
    return assemble_items(
        list_images(spark, path, split),
        read_annotations(spark, path),
        split,
        image_dims(spark, path) if header_sizes else None,
    )


def quarantined(annotations: DataFrame, dims: DataFrame | None, split: str | None) -> DataFrame:
    """(path, reason, source_split) of the files that give no item."""
    found = annotations.where("xml_error IS NOT NULL").select(F.col("xml_path").alias("path"), F.col("xml_error").alias("reason"))
    if dims is not None:
        images = dims.where("NOT readable").select(F.col("image_path").alias("path"), F.lit("unreadable image").alias("reason"))
        found = found.unionByName(images)
    return found.withColumn("source_split", F.lit(split).cast("string"))


def load_quarantine(spark: SparkSession, paths: dict[str, str], header_sizes: bool = True) -> DataFrame:
    """Broken files of the splits whose folder exists."""
    found = [
        quarantined(read_annotations(spark, p), image_dims(spark, p) if header_sizes else None, s)
        for s, p in paths.items()
        if path_exists(spark, p)
    ]
    return reduce(DataFrame.unionByName, found, spark.createDataFrame([], QUARANTINE))


def load_splits(spark: SparkSession, paths: dict[str, str], header_sizes: bool = True) -> DataFrame:
    """Union of the splits whose folder exists, tagged with their name."""
    splits = [load_split(spark, p, s, header_sizes) for s, p in paths.items() if path_exists(spark, p)]
    if not splits:
        return spark.createDataFrame([], BASE)
    return reduce(DataFrame.unionByName, splits)
