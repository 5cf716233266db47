"""Files: XML sidecars, images, JSON lines, CSV exports and the artifact catalogue."""

import base64
import os

import pytest
from helpers import png, rows
from pyspark.sql import functions as F

from goldquarry import schema
from goldquarry.operators import coverage
from goldquarry.sources import annotations, artifacts, images, items, stages


def xml(size="<size><width>20.0</width><height>10</height></size>", objects=""):
    return f"<annotation>{size}{objects}</annotation>"


def obj(inner):
    return f"<object><name>d</name>{inner}</object>"


BOX = "<bndbox><xmin>1</xmin><ymin>2.5</ymin><xmax>3</xmax><ymax>4</ymax></bndbox>"


@pytest.fixture
def folder(tmp_path):
    """A split: two image folders, sidecars, junk, upper-case suffix and a file in the root."""
    grey = lambda x, y: (10 * x, 10 * x, 10 * x)
    root = tmp_path / "split one"
    (root / "a").mkdir(parents=True)
    (root / "b" / "deep").mkdir(parents=True)
    (root / "root.png").write_bytes(png(4, 4, grey))
    (root / "a" / "one.png").write_bytes(png(20, 10, grey))
    (root / "a" / "TWO.PNG").write_bytes(png(4, 3, grey))
    (root / "b" / "deep" / "VS_P3.png").write_bytes(png(5, 6, grey))
    (root / "b" / "junk.jpg").write_bytes(b"not an image")
    (root / "b" / "notes.txt").write_text("x")
    (root / "a" / "one.xml").write_text(xml(objects=obj(BOX)))
    (root / "b" / "one.xml").write_text(xml(objects=obj(BOX) + obj("") + obj(BOX)))
    (root / "b" / "TWO.xml").write_text(xml(size=""))
    (root / "rootless.xml").write_text(xml(objects=obj(BOX)))
    (root / "b" / "lonely.xml").write_text(xml(objects=obj("<bndbox><xmax>7</xmax></bndbox>")))
    return str(root)


def test_annotations(spark, folder):
    got = {r.image_id: r for r in annotations.read_annotations(spark, folder).collect()}
    assert sorted(got) == ["TWO", "lonely", "one"]
    assert got["one"].xml_path == f"{folder}/b/one.xml"
    assert (got["one"].width, got["one"].height) == (20, 10)
    assert [tuple(b) for b in got["one"].bbox] == [(1.0, 2.5, 3.0, 4.0)] * 2
    assert [tuple(b) for b in got["lonely"].bbox] == [(0.0, 0.0, 7.0, 0.0)]
    assert (got["TWO"].width, got["TWO"].height, got["TWO"].bbox) == (0, 0, [])


def test_listing_skips_root_files(spark, folder):
    got = rows(images.list_images(spark, folder, "s"), "image_id", "image_path", "source_split")
    assert [r[0] for r in got] == ["TWO", "VS_P3", "junk", "one"]
    assert all(os.path.isfile(r[1]) and r[2] == "s" for r in got)


def test_listing_reads_no_content(spark, folder):
    listing = images.list_images(spark, folder)
    text = listing._sc._jvm.PythonSQLUtils.explainString(listing._jdf.queryExecution(), "formatted")
    scan = [line for line in text.splitlines() if "ReadSchema" in line]
    assert scan and all("content" not in line for line in scan)


def test_odd_file_names(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    name = "50%25 a+b \u00e9"
    (folder / f"{name}.png").write_bytes(png(3, 4, lambda x, y: (0, 0, 0)))
    (folder / f"{name}.xml").write_text(xml(objects=obj(BOX)))
    path = str(folder / name)
    assert rows(images.list_images(spark, str(tmp_path)), "image_id", "image_path") == [(name, path + ".png")]
    assert rows(images.image_dims(spark, str(tmp_path))) == [(path + ".png", 3, 4, True)]
    assert rows(annotations.read_annotations(spark, str(tmp_path)), "image_id", "xml_path") == [(name, path + ".xml")]
    assert images.list_images(spark, str(folder)).count() == 0
    assert images.list_images(spark, f"file://{tmp_path}/").count() == 1


def test_sizes_without_headers(spark, folder):
    got = {r.image_id: (r.width, r.height) for r in items.load_split(spark, folder, "s", header_sizes=False).collect()}
    assert got["one"] == (20, 10) and got["VS_P3"] == (0, 0)


def test_dims_quarantine_junk(spark, folder):
    got = {r.image_path.rsplit("/", 1)[1]: (r.width, r.height, r.readable) for r in images.image_dims(spark, folder).collect()}
    assert got["one.png"] == (20, 10, True)
    assert got["junk.jpg"] == (0, 0, False)


def test_load_splits(spark, folder):
    df = items.load_splits(spark, {"test": folder, "gone": folder + "/none"})
    assert df.columns == schema.BASE.fieldNames()
    got = {r.image_id: r for r in df.collect()}
    assert (got["one"].width, got["one"].height, got["one"].box_count, got["one"].drone_present) == (20, 10, 2, True)
    assert (got["TWO"].width, got["TWO"].height, got["TWO"].drone_present) == (0, 0, False)
    assert (got["VS_P3"].width, got["VS_P3"].height, got["VS_P3"].drone_present) == (5, 6, True)
    assert got["VS_P3"].bbox == [] and got["VS_P3"].xml_path is None
    assert {r.source_split for r in got.values()} == {"test"}
    assert items.load_splits(spark, {"gone": folder + "/none"}).count() == 0


def test_contents_base64(spark, folder):
    df = images.with_content_b64(images.read_contents(spark, folder)).where(F.col("image_path").endswith("one.png"))
    row = df.first()
    assert base64.b64decode(row.content_b64) == bytes(row.content)
    assert "\n" not in row.content_b64


def test_jsonl_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.jsonl")
    base = spark.createDataFrame(
        [("0001", True, False), ("2", None, True)], "image_id string, drone_present boolean, is_synthetic boolean"
    )
    artifacts.write_jsonl(base, path)
    with open(os.path.join(path, "part-extra.json"), "w") as f:
        f.write('\n\n{"image_id": "3", "drone_present": "TRUE", "is_synthetic": "no"}\n\n')
    got = rows(artifacts.read_jsonl(spark, path, base.schema))
    assert got == [("0001", True, False), ("2", False, True), ("3", True, False)]


def test_catalogue(spark, tmp_path):
    root = str(tmp_path)
    golden = spark.createDataFrame([("a",), ("b",)], "image_id string")
    full = golden.select(
        *[F.col("image_id") if f.name == "image_id" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.GOLDEN.fields]
    )
    artifacts.write_dataset(full, root, "golden")
    artifacts.write_dataset(full.select(*schema.CURATED.fieldNames()), root, "curated", fmt="json")
    assert artifacts.load_dataset(spark, root, "eval") is None
    # A newer version without its success mark is a write that did not finish.
    os.makedirs(f"{artifacts.artifact_path(root, 'golden')}/000002.parquet")
    got = {r.name: (r.available, r.rows) for r in artifacts.catalogue(spark, root).collect()}
    assert got["golden"] == (True, 2) and got["curated"] == (True, 2) and got["raw"] == (False, 0)


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [(True, "large", "sky"), (False, None, "trees")],
        "drone_present boolean, drone_visibility string, background string",
    )
    table = coverage.coverage(df, min_count=2)
    tabs = coverage.crosstabs(df, [("drone_present", "background", False)])
    artifacts.export_coverage(table, coverage.gaps(table, 2), tabs, str(tmp_path))
    back = spark.read.option("header", True).csv(f"{tmp_path}/coverage")
    assert back.count() == table.count()
    assert spark.read.option("header", True).csv(f"{tmp_path}/coverage_crosstab").count() == 7
    assert spark.read.option("header", True).csv(f"{tmp_path}/coverage_gaps").columns == ["dimension", "value", "count", "min_count"]


def test_runs_do_not_overwrite_each_other(spark, tmp_path):
    one = spark.createDataFrame([("a", 1)], "query_id string, score int")
    for label, df in (("m1", one), ("m2", one.union(one)), ("m1", one)):
        artifacts.write_run(df, df.limit(1), str(tmp_path), label)
    found = spark.read.json(f"{tmp_path}/retrieval_results").groupBy("run").count()
    assert rows(found) == [("m1", 1), ("m2", 2)]


def test_stage_root_is_the_checkpoint_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert stages.stage_root(spark) == root
    stored = stages.store_stage(spark.range(3), "numbers")
    assert rows(stored) == [(0,), (1,), (2,)]
    assert all(f.startswith(f"file://{root}") for f in stored.inputFiles())


def test_broken_files_are_reported_and_give_no_items(spark, tmp_path):
    folder = tmp_path / "q"
    folder.mkdir()
    for name in ("good", "cut", "word", "empty", "plain"):
        (folder / f"{name}.png").write_bytes(png(3, 4, lambda x, y: (1, 2, 3)))
    (folder / "junk.png").write_bytes(b"no image")
    (folder / "good.xml").write_text(xml(objects=obj(BOX)))
    (folder / "cut.xml").write_text(xml(objects=obj(BOX))[:-30])
    (folder / "word.xml").write_text(xml(objects=obj("<bndbox><xmin>abc</xmin></bndbox>")))
    (folder / "empty.xml").write_text("<other/>")
    paths = {"s": str(tmp_path)}
    assert rows(items.load_splits(spark, paths), "image_id", "drone_present") == [("good", True), ("plain", False)]
    found = [(p.rsplit("/", 1)[1], reason, split) for p, reason, split in rows(items.load_quarantine(spark, paths))]
    assert sorted(found) == [
        ("cut.xml", "unreadable annotation", "s"), ("empty.xml", "unreadable annotation", "s"),
        ("junk.png", "unreadable image", "s"), ("word.xml", "unreadable annotation", "s"),
    ]


def test_crosstab_files_are_tables(spark, tmp_path):
    df = spark.createDataFrame(
        [(True, "large", "sky"), (True, None, "sky"), (False, None, "trees.x")],
        "drone_present boolean, drone_visibility string, background string",
    )
    tabs = coverage.crosstabs(df, [("drone_present", "background", False), ("drone_present", "drone_visibility", True)])
    table = coverage.coverage(df, min_count=2)
    artifacts.export_coverage(table, coverage.gaps(table, 2), tabs, str(tmp_path))
    read = lambda tab: spark.read.option("header", True).csv(f"{tmp_path}/coverage_crosstab_{tab}")
    wide = read("drone_present_x_background")
    assert wide.columns == ["drone_present", "sky", "trees.x", "All"]
    assert [tuple(r) for r in wide.collect()] == [("no", "0", "1", "1"), ("yes", "2", "0", "2"), ("All", "2", "1", "3")]
    assert [tuple(r) for r in read("drone_present_x_drone_visibility").collect()] == [("yes", "1", "1"), ("All", "1", "1")]
