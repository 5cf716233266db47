"""The annotation scanner against Spark's XML parser, and sizes from headers."""

import random
import struct

import pyarrow as pa
import pytest
from helpers import png
from pyspark.sql import functions as F

from goldquarry.schema import ANNOTATION_XML
from goldquarry.sources import headers, images, tag_scan
from goldquarry.sources.annotations import annotation_columns, parse_annotations

BOX = "<bndbox><xmin>1</xmin><ymin>2.5</ymin><xmax>30</xmax><ymax>4</ymax></bndbox>"
PLAIN = [
    "<annotation></annotation>",
    " <annotation>\n<size><width>20.7</width><height>010</height><depth>3</depth></size> </annotation>\n",
    f"<annotation><size><height>9</height></size><object><name>d e</name>{BOX}</object><object><name>x</name></object></annotation>",
    f"<annotation><object>{BOX}<pose>left</pose></object><object><bndbox><ymax>.5</ymax></bndbox></object></annotation>",
    "<annotation><folder>annotation</folder><other><width>7</width><xmin>abc</xmin></other><size></size></annotation>",
    "<annotation><object><bndbox></bndbox></object></annotation>",
]
OTHER = [
    None, "", "x", "<", ">", "<annotation>", "</annotation>", "<annotation><size></annotation></size>", "<other/>",
    "<annotation><size><width>abc</width></size></annotation>", "<annotation><size><width></width></size></annotation>",
    "<annotation a='1'><size><width>3</width></size></annotation>", "<annotation><!-- > --><size><width>4</width></size></annotation>",
    "<?xml version='1.0'?><annotation><size><width>5</width></size></annotation>", "<annotation><size/></annotation>",
    "<annotation><size><width>1</width></size><size><width>2</width></size></annotation>",
    "<annotation><size><width>&#49;</width></size></annotation>", "<annotation><size><width>1e2</width><height>-3</height></size></annotation>",
    "<annotation><size><width> 6 </width></size></annotation>", "<annotation><a><b><c><d>1</d></c></b></a></annotation>",
    f"<annotation><object>{BOX}{BOX}</object></annotation>", f"<data><annotation><object>{BOX}</object></annotation></data>",
    "<annotation></annotation><annotation></annotation>", "text <annotation></annotation>", "<annotation></annotation> text",
    "<annotation><a>></a></annotation>", "<annotation><very_long_element_name_that_goes_on>1</very_long_element_name_that_goes_on></annotation>",
    "<annotation><size><width><b>1</b></width></size></annotation>", "<annotation><object><bndbox><xmin>1</xmax></bndbox></object></annotation>",
    "<annotation><size><width>1.2.3</width></size></annotation>", "<annotation><size><width>.</width></size></annotation>", "é",
]


def test_plain_texts_are_told(spark):
    got = [r["plain"] for r in tag_scan.scan_annotations(pa.array(PLAIN + OTHER)).to_pylist()]
    assert got[: len(PLAIN)] == [True] * len(PLAIN) and not any(got[len(PLAIN) :])


def spoiled(rng):
    """A random annotation, some with a few characters lost or doubled."""
    parts = ["<annotation>"]
    for _ in range(rng.randrange(4)):
        parts.append(rng.choice(PLAIN[1:])[12:-13] if rng.random() < 0.3 else rng.choice([
            "<size><width>5</width><height>6</height></size>", f"<object>{BOX}</object>", "<object><name>a</name></object>", " ", "note"]))
    text = "".join([*parts, "</annotation>"])
    if rng.random() < 0.4:
        at = rng.randrange(len(text))
        text = text[:at] + rng.choice(["", "<", ">", "/", "x", "<b>", "</b>", "9"]) + text[at + rng.randrange(2) :]
    return text


@pytest.mark.parametrize("limit", [1, 300, 1 << 20])
def test_scanner_agrees_with_the_parser(spark, monkeypatch, limit):
    monkeypatch.setattr(tag_scan, "SLICE_BYTES", limit)
    rng = random.Random(limit)
    texts = PLAIN + OTHER + [spoiled(rng) for _ in range(1500)]
    scanned = tag_scan.scan_annotations(pa.array(texts)).to_pylist()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    parsed = df.withColumn("p", F.from_xml("x", ANNOTATION_XML, {"rowTag": "annotation"}))
    values = annotation_columns(F.col("p.size"), F.col("p.object"), F.col("p._corrupt_record"))
    want = {r.i: r for r in parsed.select("i", *[c.alias(n) for n, c in values.items()]).collect()}
    assert sum(s["plain"] for s in scanned) > 500
    for i, s in enumerate(scanned):
        if s["plain"]:
            boxes = [tuple(b.values()) for b in s["bbox"]]
            assert want[i].xml_error is None, texts[i]
            assert (s["width"], s["height"], boxes) == (want[i].width, want[i].height, [tuple(b) for b in want[i].bbox]), texts[i]
    got = {r.i: r for r in parse_annotations(df, "x").collect()}
    for i in range(len(texts)):
        assert all(got[i][n] == want[i][n] for n in ("width", "height", "bbox", "xml_error")), texts[i]


def test_only_other_texts_reach_the_parser(spark):
    df = spark.createDataFrame([(t,) for t in PLAIN], "x string").withColumn("x", F.col("x"))
    plan = parse_annotations(df, "x")
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert text.count("ArrowEvalPython") == 1 and "plain" in text and text.count("from_xml") >= 1


def segment(marker, body):
    return b"\xff" + bytes([marker]) + struct.pack(">H", len(body) + 2) + body


def jpeg(width, height, before=b"", frame=0xC0):
    frame = segment(frame, struct.pack(">BHHB", 8, height, width, 1) + b"\x01\x11\x00")
    return b"\xff\xd8" + before + frame + segment(0xDA, b"\x01\x01\x00\x00\x3f\x00") + b"\x12\x34" * 50 + b"\xff\xd9"


def test_sizes_from_headers(spark, tmp_path):
    folder = tmp_path / "a"
    folder.mkdir()
    grey = lambda x, y: (1, 2, 3)
    app = segment(0xE1, b"\xff\xc0" + b"e" * 60_000)
    files = {
        "plain.jpg": (jpeg(640, 480), (640, 480, True)),
        "progressive.JPEG": (jpeg(31, 17, frame=0xC2), (31, 17, True)),
        "padded.jpg": (jpeg(5, 6, before=b"\xff\xff\xff\x01"), (5, 6, True)),
        "table_first.jpg": (jpeg(7, 8, before=segment(0xC4, b"\0" * 30)), (7, 8, True)),
        "long_header.jpg": (jpeg(9, 10, before=app * 3), (9, 10, True)),
        "cut.jpg": (jpeg(640, 480)[:60], (0, 0, False)),
        "cut_header.jpg": (jpeg(640, 480)[:10], (0, 0, False)),
        "no_frame.jpg": (b"\xff\xd8" + segment(0xDA, b"x") + b"\xff\xd9", (0, 0, False)),
        "zero.jpg": (jpeg(0, 3), (0, 0, False)),
        "junk.jpg": (b"not an image", (0, 0, False)),
        "good.png": (png(20, 10, grey), (20, 10, True)),
        "cut.png": (png(20, 10, grey)[:-8], (0, 0, False)),
        "stub.png": (png(20, 10, grey)[:20], (0, 0, False)),
        "png.jpg": (png(3, 2, grey), (3, 2, True)),
    }
    for name, (content, _) in files.items():
        (folder / name).write_bytes(content)
    dims = images.image_dims(spark, str(tmp_path))
    got = {r.image_path.rsplit("/", 1)[1]: (r.width, r.height, r.readable) for r in dims.collect()}
    assert got == {name: want for name, (_, want) in files.items()}
    text = dims._sc._jvm.PythonSQLUtils.explainString(dims._jdf.queryExecution(), "formatted")
    assert "binaryFile" in text and "Format: image" not in text


def test_every_cut_of_a_file_is_unreadable():
    for content in (jpeg(640, 480, before=segment(0xE0, b"JFIF")), png(4, 3, lambda x, y: (0, 0, 0))):
        assert headers.picture_size(content, content[-1024:])[0] > 0
        for n in range(len(content) - 1):
            assert headers.picture_size(content[:n], content[:n][-1024:])[:2] == (0, 0)
