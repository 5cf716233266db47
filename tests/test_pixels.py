"""Image statistics against plain loops over the pixels."""

import random

import numpy as np
import pytest
from helpers import png, rows
from pyspark.sql import functions as F

from goldquarry.operators import pixels
from goldquarry.sources.images import read_images


def slow_sharpness(grey):
    height, width = len(grey), len(grey[0])
    if height < 3 or width < 3:
        return 0.0
    found = []
    y = 1
    while y < height - 1:
        x = 1
        while x < width - 1:
            around = grey[y - 1][x] + grey[y + 1][x] + grey[y][x - 1] + grey[y][x + 1]
            found.append(around - 4 * grey[y][x])
            x += max(1, width // 160)
        y += max(1, height // 160)
    mean = sum(found) / len(found)
    return sum((v - mean) ** 2 for v in found) / len(found)


@pytest.mark.parametrize("width, height", [(20, 10), (2, 2), (3, 3), (400, 330), (161, 5), (2, 9)])
def test_sharpness(width, height):
    rng = random.Random(width * height)
    grey = [[float(rng.randrange(256)) for _ in range(width)] for _ in range(height)]
    assert pixels.sharpness(np.array(grey)) == pytest.approx(slow_sharpness(grey))


def test_luma_weights():
    one = lambda r, g, b: pixels.luma(np.array([[[b, g, r]]], np.uint8))[0, 0]
    assert [one(255, 0, 0), one(0, 255, 0), one(0, 0, 255), one(255, 255, 255)] == [76, 150, 29, 255]
    assert pixels.luma(np.array([[[7]]], np.uint8))[0, 0] == 7


def test_image_stats_keeps_every_item(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    flat = folder / "flat.png"
    flat.write_bytes(png(8, 8, lambda x, y: (100, 100, 100)))
    busy = folder / "busy.png"
    busy.write_bytes(png(8, 8, lambda x, y: (255, 255, 255) if (x + y) % 2 else (0, 0, 0)))
    (folder / "junk.jpg").write_bytes(b"junk")
    items = spark.createDataFrame(
        [
            ("flat", str(flat), True, [(0.0, 0.0, 4.0, 4.0)], 8, 8),
            ("busy", str(busy), False, [(0.0, 0.0, 4.0, 4.0)], 8, 8),
            ("junk", str(folder / "junk.jpg"), True, [], 8, 8),
            ("gone", str(folder / "gone.png"), True, [(0.0, 0.0, 1.0, 1.0)], 0, 8),
            ("null", None, None, None, None, None),
        ],
        "image_id string, image_path string, drone_present boolean, "
        "bbox array<struct<xmin: double, ymin: double, xmax: double, ymax: double>>, width int, height int",
    )
    out = pixels.image_stats(items, read_images(spark, str(tmp_path)))
    got = {r.image_id: (r.blur_score, r.brightness, r.bbox_ratio) for r in out.collect()}
    assert got["flat"] == (0.0, 100.0, 0.25)
    sign = [[-1.0 if (x + y) % 2 else 1.0 for x in range(1, 7)] for y in range(1, 7)]
    assert got["busy"][0] == pytest.approx(np.var(np.array(sign) * 1020)) and got["busy"][1:] == (127.5, None)
    assert got["junk"] == (None, None, None) and got["gone"] == (None, None, None)
    assert got["null"] == (None, None, None)


def test_grid_matches_image_statistics(spark):
    rng = random.Random(3)
    grids = [[float(rng.randrange(256)) for _ in range(7 * 5)] for _ in range(4)] + [[1.0]]
    df = spark.createDataFrame([(i, g) for i, g in enumerate(grids)], "i int, g array<double>")
    out = pixels.grid_stats(df, F.col("g"), 7, 5).orderBy("i").collect()
    for row, grid in zip(out[:4], grids):
        grey = np.array(grid).reshape(5, 7)
        assert row.blur_score == pytest.approx(pixels.sharpness(grey))
        assert row.brightness == pytest.approx(grey.mean())
    assert (out[4].blur_score, out[4].brightness) == (None, None)


def test_blur(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    (folder / "dot.png").write_bytes(png(21, 15, lambda x, y: (255, 0, 0) if (x, y) == (10, 7) else (0, 0, 0)))
    images = read_images(spark, str(tmp_path)).select(F.lit("dot").alias("image_id"), "image")
    row = pixels.blur_images(images).first()
    data = np.frombuffer(row.image.data, np.uint8).reshape(15, 21, 3)
    assert row.image_id == "dot__blur" and (row.image.width, row.image.height) == (21, 15)
    assert data[..., :2].max() == 0
    red = data[..., 2].astype(int)
    assert red.argmax() == 7 * 21 + 10 and 0 < red.max() < 20
    assert (red == red[:, ::-1]).all() and (red == red[::-1]).all()
    constant = np.full((6, 9, 3), 77, np.uint8)
    assert (pixels.gaussian_blur(constant) == 77).all()
