"""Image statistics and blur over pixel data.

Statistics of encoded images run as one Arrow job per image partition; only the statistics, not
the pixels, are joined to the items. Run pixel jobs with a small
``spark.sql.execution.arrow.maxRecordsPerBatch`` (for example 32), since one row is one image.
"""

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.geometry import largest_box_ratio
from goldquarry.schema import IMAGE


def _pixels(row) -> np.ndarray:
    return np.frombuffer(row.data, np.uint8).reshape(row.height, row.width, row.nChannels)


def luma(pixels: np.ndarray) -> np.ndarray:
    """Grey levels 0..255 of BGR(A) or single-channel pixels, in 16-bit fixed point."""
    if pixels.shape[2] < 3:
        return pixels[..., 0].astype(float)
    weighted = pixels[..., 2::-1].astype(np.int64) @ np.array(fv.LUMA_WEIGHTS)
    return ((weighted + fv.LUMA_SCALE // 2) // fv.LUMA_SCALE).astype(float)


def sharpness(grey: np.ndarray) -> float:
    """Population variance of the 4-neighbour Laplacian on a strided grid of interior pixels."""
    height, width = grey.shape
    if min(height, width) < 3:
        return 0.0
    sides = grey[1:-1, :-2] + grey[1:-1, 2:] + grey[:-2, 1:-1] + grey[2:, 1:-1]
    laplacian = sides - 4.0 * grey[1:-1, 1:-1]
    step = [max(1, n // fv.PIXEL_SAMPLES_PER_SIDE) for n in (height, width)]
    return float(laplacian[:: step[0], :: step[1]].var())


def pixel_stats(images: DataFrame) -> DataFrame:
    """(image_path, blur_score, brightness) of (image_path, image) rows; null for unreadable files."""

    def run(batches):
        for batch in batches:
            stats = []
            for row in batch.itertuples():
                grey = luma(_pixels(row)) if row.height > 0 else None
                stats.append((None, None) if grey is None else (sharpness(grey), float(grey.mean())))
            yield pd.DataFrame(stats, columns=["blur_score", "brightness"], dtype=float).assign(
                image_path=batch["image_path"].values
            )[["image_path", "blur_score", "brightness"]]

    flat = images.select("image_path", "image.height", "image.width", "image.nChannels", "image.data")
    stats = flat.mapInPandas(run, "image_path string, blur_score double, brightness double")
    null_if_nan = lambda c: F.nanvl(c, F.lit(None).cast("double"))
    return stats.withColumns({c: null_if_nan(F.col(c)) for c in ("blur_score", "brightness")})


def with_box_ratio(items: DataFrame) -> DataFrame:
    return items.withColumn(
        "bbox_ratio",
        largest_box_ratio(F.col("drone_present"), F.col("bbox"), F.col("width"), F.col("height")),
    )


def image_stats(items: DataFrame, images: DataFrame) -> DataFrame:
    """Items with blur_score, brightness and bbox_ratio; one row per item, nulls without a file."""
    stats = pixel_stats(images)
    return with_box_ratio(items.join(stats, "image_path", "left").select(*items.columns, "blur_score", "brightness"))


def _kernel(radius: float) -> np.ndarray:
    reach = int(np.ceil(3 * radius))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / radius) ** 2)
    return weights / weights.sum()


def gaussian_blur(pixels: np.ndarray, radius: float = fv.BLUR_RADIUS) -> np.ndarray:
    """Separable Gaussian blur, edges repeated, rounded to bytes."""
    kernel = _kernel(radius)
    reach = len(kernel) // 2
    out = pixels.astype(float)
    for axis in (0, 1):
        size = out.shape[axis]
        pad = [(reach, reach) if a == axis else (0, 0) for a in range(3)]
        padded = np.pad(out, pad, mode="edge")
        out = sum(
            w * np.take(padded, np.arange(i, i + size), axis=axis) for i, w in enumerate(kernel)
        )
    return np.clip(np.floor(out + 0.5), 0, 255).astype(np.uint8)


def blur_images(images: DataFrame, radius: float = fv.BLUR_RADIUS) -> DataFrame:
    """Blurred pixels of (image_id, image) rows: (image_id, image) with the variant id."""

    def run(batches):
        for batch in batches:
            batch["data"] = [gaussian_blur(_pixels(r), radius).tobytes() for r in batch.itertuples()]
            batch["image_id"] = batch["image_id"] + fv.BLUR_ID_SUFFIX
            yield batch

    names = IMAGE.fieldNames()
    flat = images.where(F.col("image.height") > 0).select("image_id", *[f"image.{n}" for n in names])
    blurred = flat.mapInPandas(run, flat.schema)
    return blurred.select("image_id", F.struct(*names).alias("image"))


def png_bytes(pixels: np.ndarray) -> bytes:
    """A PNG file of BGR(A) or single-channel pixels."""
    height, width, channels = pixels.shape
    order, kind = {1: ([0], 0), 3: ([2, 1, 0], 2), 4: ([2, 1, 0, 3], 6)}[channels]
    lines = np.concatenate([np.zeros((height, 1), np.uint8), pixels[..., order].reshape(height, -1)], axis=1)
    parts = [
        (b"IHDR", struct.pack(">IIBBBBB", width, height, 8, kind, 0, 0, 0)),
        (b"IDAT", zlib.compress(lines.tobytes())),
        (b"IEND", b""),
    ]
    chunks = [struct.pack(">I", len(d)) + n + d + struct.pack(">I", zlib.crc32(n + d)) for n, d in parts]
    return b"\x89PNG\r\n\x1a\n" + b"".join(chunks)


def blurred_files(images: DataFrame, radius: float = fv.BLUR_RADIUS) -> DataFrame:
    """(image_path, content) of the blurred pictures of (image_path, image) rows, as PNG files.

    One pass where the pixels lie; unreadable images have none.
    """

    def run(batches):
        for batch in batches:
            content = [png_bytes(gaussian_blur(_pixels(r), radius)) for r in batch.itertuples()]
            yield pd.DataFrame({"image_path": batch["image_path"], "content": content})

    names = ("height", "width", "nChannels", "data")
    flat = images.where(F.col("image.height") > 0).select("image_path", *[f"image.{n}" for n in names])
    return flat.mapInPandas(run, "image_path string, content binary")


def grid_brightness(grid: Column) -> Column:
    total = F.aggregate(grid, F.lit(0.0), lambda acc, v: acc + v)
    return F.try_divide(total, F.size(grid))


def grid_sharpness(grid: Column, width: int, height: int) -> Column:
    """The sharpness above for grey levels held row by row in an array column."""
    if min(width, height) < 3:
        return F.lit(0.0)
    rows, cols = (
        range(1, n - 1, max(1, n // fv.PIXEL_SAMPLES_PER_SIDE)) for n in (height, width)
    )
    centres = F.array(*[F.lit(y * width + x) for y in rows for x in cols])
    at = lambda i: F.get(grid, i)
    laplacian = F.transform(
        centres,
        lambda i: at(i - 1) + at(i + 1) + at(i - width) + at(i + width) - F.lit(4.0) * at(i),
    )
    count = len(rows) * len(cols)
    moments = F.aggregate(
        laplacian,
        F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
        lambda acc, v: F.struct((acc["s"] + v).alias("s"), (acc["q"] + v * v).alias("q")),
    )
    mean = moments["s"] / count
    variance = moments["q"] / count - mean * mean
    # A missing level makes the result null; greatest() alone would turn that into 0.
    return F.when(variance.isNotNull(), F.greatest(variance, F.lit(0.0)))


def grid_stats(df: DataFrame, grid: Column, width: int, height: int) -> DataFrame:
    """Add blur_score and brightness of an array column of grey levels; null if the size is wrong."""
    fits = F.size(grid) == width * height
    return df.withColumn("_grid", F.when(fits, grid)).withColumns(
        {
            "blur_score": grid_sharpness(F.col("_grid"), width, height),
            "brightness": grid_brightness(F.col("_grid")),
        }
    ).drop("_grid")
