"""Column functions on the cases that are easy to get wrong."""

import pytest
from pyspark.sql import functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions import geometry as geo
from goldquarry.functions import labels as lab
from goldquarry.functions import predicates as pred
from goldquarry.functions import text
from goldquarry.params import JobParams


def values(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_missing_values(spark):
    got = values(spark, [None, "", "None", "NAN", "x", " "], "string", pred.has_value)
    assert got == [False, False, False, False, True, True]
    assert values(spark, [None, float("nan"), 0.0], "double", pred.has_value) == [False, False, True]


def test_negated_predicate_keeps_null_rows(spark):
    got = values(spark, ["a", "b", None], "string", lambda c: ~pred.holds(c == "a"))
    assert got == [False, True, True]


def test_range_is_inclusive_and_passes_missing(spark):
    data = [None, float("nan"), 24.999, 25.0, 235.0, 235.1]
    got = values(spark, data, "double", lambda c: pred.within(c, 25.0, 235.0))
    assert got == [True, True, False, True, True, False]
    assert values(spark, [1.0], "double", lambda c: pred.within(c, None, None)) == [True]


def test_confusers(spark):
    cases = {
        (" Kite ", "none"): ["bird"],
        ("PLANE!?", "airplane", "Helicopter;"): ["aircraft", "helicopter"],
        ("dog",): ["none"],
        (): ["none"],
        None: ["none"],
        ("bird", None): ["bird"],
        ("bird !",): ["none"],
        (" bird\n",): ["bird"],
    }
    got = values(spark, [None if k is None else list(k) for k in cases], "array<string>", lab.coerce_labels)
    assert got == list(cases.values())
    again = values(spark, got, "array<string>", lab.coerce_labels)
    assert again == got


def test_enum_is_exact(spark):
    make = lambda c: lab.coerce_enum(c, *fv.ENUM_DEFAULTS["blur_bucket"])
    assert values(spark, ["mild", "Mild", None, "unknown"], "string", make) == ["mild", "sharp", "sharp", "sharp"]


@pytest.mark.parametrize(
    "raw, phrase, score",
    [
        ("I am definitely yes!", "definitely yes", 5),
        ("definitely not", "definitely no", 1),
        ("probably yes or definitely no", "definitely no", 1),
        ("PROBABLY YES, probably no", "probably yes", 4),
        ("yes", "uncertain", 3),
        ("", "uncertain", 3),
        (None, "uncertain", 3),
        ("Probably not", "probably no", 2),
    ],
)
def test_grade(spark, raw, phrase, score):
    got = values(spark, [raw], "string", lab.grade)[0]
    assert tuple(got) == (phrase, score)


def test_status(spark):
    data = [None, [], ["none"], ["bird"], ["none", "bird"]]
    got = values(spark, data, "array<string>", lab.curation_status)
    assert got == ["keep", "keep", "keep", "needs_review", "needs_review"]


BOXED = "present boolean, boxes array<array<double>>, w int, h int"


def visibility(spark, *cases):
    df = spark.createDataFrame(list(cases), BOXED)
    bbox = geo.boxes_from_lists(F.col("boxes"))
    out = df.select(
        geo.visibility_bucket(F.col("present"), bbox, F.col("w"), F.col("h")).alias("v"),
        geo.largest_box_ratio(F.col("present"), bbox, F.col("w"), F.col("h")).alias("r"),
    )
    return [tuple(r) for r in out.collect()]


def test_visibility_edges(spark):
    got = visibility(
        spark,
        (True, [[0.0, 0.0, 2.0, 1.0]], 10, 10),
        (True, [[0.0, 0.0, 1.0, 0.5]], 10, 10),
        (True, [[0.0, 0.0, 1.0, 0.49]], 10, 10),
        (True, [], 10, 10),
        (True, [[0.0, 0.0, 5.0, 5.0]], 0, 10),
        (True, [[5.0, 5.0, 0.0, 0.0]], 10, 10),
        (True, [[0.0, 0.0, 20.0, 10.0]], 10, 10),
        (True, [[0.0, 0.0, 9.0], [0.0, 0.0, 1.0, 1.0]], 10, 10),
        (False, [[0.0, 0.0, 5.0, 5.0]], 10, 10),
        (None, [[0.0, 0.0, 5.0, 5.0]], 10, 10),
        (True, None, None, 10),
    )
    assert got == [
        ("large", 0.02),
        ("medium", 0.005),
        ("small", 0.0049),
        ("small", None),
        ("small", None),
        ("small", None),
        ("large", 2.0),
        ("medium", 0.01),
        (None, None),
        (None, None),
        ("small", None),
    ]


def test_rescale_uses_target_for_unknown_sides(spark):
    df = spark.createDataFrame([([[1.0, 2.0, 3.0, 4.0]], 0, None), ([[1.0, 2.0, 3.0, 4.0]], 100, 75)], "b array<array<double>>, w int, h int")
    out = geo.boxes_to_lists(geo.rescale_boxes(geo.boxes_from_lists(F.col("b")), F.col("w"), F.col("h"), 200, 150))
    assert [r[0] for r in df.select(out).collect()] == [[[1.0, 2.0, 3.0, 4.0]], [[2.0, 4.0, 6.0, 8.0]]]


def test_base64_has_no_line_breaks(spark):
    import base64
    import hashlib

    content = bytes(range(256)) * 3
    df = spark.createDataFrame([(content,)], "c binary")
    b64 = text.content_b64(F.col("c"))
    got = df.select(b64, text.cache_key(b64, F.lit("fog"))).first()
    plain = base64.b64encode(content).decode()
    assert got[0] == plain
    assert got[1] == hashlib.sha256(f"{plain}|fog".encode()).hexdigest()[:16]


def test_context_is_spaced_json(spark):
    import json

    df = spark.createDataFrame([('a"b\\c', True, 2), ("x", None, None)], "i string, p boolean, n int")
    got = [r[0] for r in df.select(text.annotation_context(F.col("i"), F.col("p"), F.col("n"))).collect()]
    want = [
        {"image_id": 'a"b\\c', "ground_truth_drone_present": "yes", "ground_truth_box_count": 2},
        {"image_id": "x", "ground_truth_drone_present": "no", "ground_truth_box_count": 0},
    ]
    assert got == [json.dumps(w) for w in want]


def test_stems_and_suffixes(spark):
    paths = ["/a/b.c.JPG", "/a/.hidden", "x.png", "/a/plain"]
    assert values(spark, paths, "string", text.file_stem) == ["b.c", ".hidden", "x", "plain"]
    assert values(spark, paths, "string", text.file_suffix) == [".jpg", "", ".png", ""]


def test_params():
    got = JobParams.from_mapping({"MAX_EVAL_ROWS": "7", "FORCE_REFRESH": "1", "models": "a, b", "other": "x"})
    assert (got.max_eval_rows, got.force_refresh, got.models) == (7, True, ("a", "b"))
    with pytest.raises(ValueError):
        JobParams(annotator="nobody")
