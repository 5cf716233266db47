"""Image listings, dimensions, content and pixels."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.text import content_b64, file_stem, file_suffix
from goldquarry.sources.headers import HEAD_BYTES, header_size, whole_size
from goldquarry.sources.paths import plain_path


def decoded_path(uri: Column) -> Column:
    """Plain path of a file URI: percent-encoding undone, local scheme dropped."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, r"^file:/+", "/")


def _local(path: Column) -> Column:
    return F.regexp_replace(path, r"^file:/+", "/")


def below(spark: SparkSession, path_col: Column, root: str) -> Column:
    """Whether a file lies in a folder strictly below the root."""
    folder = F.regexp_replace(path_col, r"/[^/]*$", "")
    return folder != F.lit(plain_path(spark, root))


def _glob(suffixes) -> str:
    """File name pattern of the suffixes in any case."""
    either = lambda c: f"[{c.lower()}{c.upper()}]" if c.isalpha() else c
    return "*{" + ",".join("".join(map(either, s)) for s in suffixes) + "}"


def _binary_files(spark: SparkSession, path: str, suffixes=tuple(fv.IMAGE_SUFFIXES)) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _glob(suffixes))
        .load(path)
    )
    return files.withColumn("image_path", _local(F.col("path")))


def list_images(
    spark: SparkSession, path: str, split: str | None = None, suffixes=tuple(fv.IMAGE_SUFFIXES)
) -> DataFrame:
    """(image_id, image_path, source_split) of the images in folders strictly below `path`.

    Reads file names only, no content.
    """
    return (
        _binary_files(spark, path, suffixes)
        .select("image_path")
        .where(file_suffix(F.col("image_path")).isin(list(suffixes)))
        .where(below(spark, F.col("image_path"), path))
        .select(
            file_stem(F.col("image_path")).alias("image_id"),
            "image_path",
            F.lit(split).cast("string").alias("source_split"),
        )
    )


def read_contents(spark: SparkSession, path: str) -> DataFrame:
    """(image_path, content) of the image files below `path`."""
    return _binary_files(spark, path).select("image_path", "content")


def with_content_b64(df: DataFrame, content_col: str = "content") -> DataFrame:
    """Add the content as one line of base64."""
    return df.withColumn(f"{content_col}_b64", content_b64(F.col(content_col)))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(image_path, image) with decoded pixels; files that are not images have height -1."""
    images = (
        spark.read.format("image")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _glob(fv.IMAGE_SUFFIXES))
        .option("dropInvalid", "false")
        .load(path)
    )
    return images.select(decoded_path(F.col("image.origin")).alias("image_path"), "image")


def image_dims(spark: SparkSession, path: str) -> DataFrame:
    """(image_path, width, height, readable); unreadable files get a size of 0.

    Sizes come from the file headers, no pixel is decoded. Files that are no JPEG or PNG, that are cut
    off, or whose header holds no size are unreadable.
    """
    files = read_contents(spark, path).withColumn("_first", header_size(F.col("content")))
    # The few files whose header is longer than the bytes looked at first; others reach this as nulls.
    longer = F.when(F.col("_first.cut") & (F.length("content") > HEAD_BYTES), F.col("content"))
    sized = files.withColumn("_again", whole_size(longer))
    size = lambda n: F.greatest(F.col(f"_first.{n}"), F.col(f"_again.{n}"))
    return sized.select(
        "image_path", size("width").alias("width"), size("height").alias("height"), (size("width") > 0).alias("readable")
    )
