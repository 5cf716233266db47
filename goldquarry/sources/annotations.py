"""Annotation sidecars (XML) as box tables."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from goldquarry import fixed_values as fv
from goldquarry.functions.geometry import box
from goldquarry.functions.text import file_stem
from goldquarry.schema import ANNOTATION_XML, BOXES
from goldquarry.sources.images import below, decoded_path
from goldquarry.sources.tag_scan import scan_annotations


def boxes_of(objects: Column) -> Column:
    """Boxes of the objects that have one; absent coordinates count as 0."""
    at = lambda o, n: F.coalesce(o["bndbox"][n], F.lit(0.0))
    with_box = F.filter(objects, lambda o: o["bndbox"].isNotNull())
    boxes = F.transform(
        with_box, lambda o: box(at(o, "xmin"), at(o, "ymin"), at(o, "xmax"), at(o, "ymax"))
    )
    return F.coalesce(boxes, F.array().cast(BOXES))


UNREADABLE = "unreadable annotation"


def annotation_columns(size, objects, corrupt) -> dict:
    """Frame size (whole numbers, 0 if absent), boxes and `xml_error` of a parsed annotation.

    An annotation that is cut off or holds something else than a number where one belongs has an
    error and neither size nor boxes: what is left of it is no ground truth.
    """
    good = lambda c: F.when(corrupt.isNull(), c)
    side = lambda c: good(F.coalesce(c.cast("int"), F.lit(0)))
    return {
        "width": side(size["width"]),
        "height": side(size["height"]),
        "bbox": good(boxes_of(objects)),
        "xml_error": F.when(corrupt.isNotNull(), UNREADABLE),
    }


SCANNED = T.StructType().add("plain", "boolean").add("width", "integer").add("height", "integer").add("bbox", BOXES)


@F.arrow_udf(SCANNED)
def _scan(texts: pa.Array) -> pa.Array:
    return scan_annotations(texts)


def parse_annotations(df: DataFrame, xml_col: str) -> DataFrame:
    """Add width, height, bbox and xml_error parsed from an XML string column. A null string has no error.

    Plain annotations are scanned (see `tag_scan`); all others go through the XML parser.
    """
    scanned = df.withColumn("_scan", _scan(F.col(xml_col)))
    rest = F.when(~F.col("_scan.plain"), F.col(xml_col))
    parsed = scanned.withColumn("_xml", F.from_xml(rest, ANNOTATION_XML, {"rowTag": "annotation"}))
    values = annotation_columns(F.col("_xml.size"), F.col("_xml.object"), F.col("_xml._corrupt_record"))
    pick = lambda name, c: F.when(F.col("_scan.plain"), F.col(f"_scan.{name}")).otherwise(c)
    both = {name: c if name == "xml_error" else pick(name, c) for name, c in values.items()}
    return parsed.withColumns(both).drop("_xml", "_scan")


def read_annotations(spark: SparkSession, path: str, row_tag: str = "annotation") -> DataFrame:
    """(image_id, xml_path, width, height, bbox, xml_error) of the XML files in folders strictly below `path`.

    The id is the file stem. Of files with the same stem the one with the largest path counts. A
    file without any annotation has an error as well; one of no bytes counts as no file, since
    Spark's file sources leave those out.
    """
    options = {"recursiveFileLookup": "true", "pathGlobFilter": "*.xml"}
    files = spark.read.format("xml").option("rowTag", row_tag).options(**options).schema(ANNOTATION_XML).load(path)
    values = annotation_columns(F.col("size"), F.col("object"), F.col("_corrupt_record"))
    parsed = files.select(
        decoded_path(F.col("_metadata.file_path")).alias("xml_path"), *[c.alias(n) for n, c in values.items()]
    )
    names = spark.read.format("binaryFile").options(**options).load(path).select(F.col("_metadata.file_path").alias("uri"))
    empty = names.select(decoded_path(F.col("uri")).alias("xml_path")).join(
        parsed.select("xml_path").distinct(), "xml_path", "left_anti"
    )
    rows = parsed.unionByName(empty.withColumn("xml_error", F.lit(UNREADABLE)), allowMissingColumns=True)
    rows = rows.where(below(spark, F.col("xml_path"), path)).withColumn("image_id", file_stem(F.col("xml_path")))
    last = F.max_by(F.struct("xml_path", "width", "height", "bbox", "xml_error"), "xml_path")
    return rows.groupBy("image_id").agg(last.alias("r")).select("image_id", "r.*")


def positive_prefix_test(image_id, prefix: str | None = fv.POSITIVE_ID_PREFIX):
    return image_id.startswith(prefix) if prefix else F.lit(False)
