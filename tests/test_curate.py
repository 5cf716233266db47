"""Annotation with stored responses, label edits and augmentation."""

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from goldquarry import schema
from goldquarry.functions.text import cache_key, content_b64
from goldquarry.operators import augment, curate, inference
from goldquarry.sources.buckets import append_buckets, read_buckets
from goldquarry.sources.stages import store_stage


def items(spark, ids="abcd"):
    data = [(i, f"/{i}.jpg", 10, 10, True, [(0.0, 0.0, 2.0, 1.0)], 1) for i in ids]
    return spark.createDataFrame(
        data,
        "image_id string, image_path string, width int, height int, drone_present boolean, "
        "bbox array<struct<xmin: double, ymin: double, xmax: double, ymax: double>>, box_count int",
    )


def answer(batch):
    return ['{"background": "%s", "blur_bucket": "mild", "possible_confusers": "bird"}' % i for i in batch["image_id"].map(
        lambda i: "sky" if i == "a" else 5)]


def test_annotation_labels(spark):
    out, new = inference.annotate(items(spark), answer, "m", "openai")
    got = rows(out, "image_id", "background", "lighting", "blur_bucket", "possible_confusers", "drone_visibility", "annotator", "annotation_status")
    assert got[0] == ("a", "sky", "unknown", "mild", ["none"], "large", "openai", "ok")
    assert got[1] == ("b", "unknown", "unknown", "mild", ["none"], "large", "openai", "ok")
    assert new.columns == schema.RESPONSES.fieldNames()
    raw = out.first().raw
    assert (raw.model, raw.caption, raw.visibility_source, raw.schema_version) == ("m", "", "ground_truth_bbox", "odd_v3")


def test_answered_requests_are_not_asked_again(spark):
    _, first = inference.annotate(items(spark, "ab"), answer, "m", store=lambda df: store_stage(df, "r"))
    strict = lambda batch: ["nothing useful"] * len(batch)
    out, new = inference.annotate(items(spark), strict, "m", responses=first)
    assert rows(new, "image_id") == [("c",), ("d",)]
    assert rows(out, "image_id", "annotation_status") == [("a", "ok"), ("b", "ok"), ("c", "no_object"), ("d", "no_object")]
    for more in ({"refresh": True}, {"schema_version": "next"}):
        assert inference.annotate(items(spark), strict, "m", responses=first, **more)[1].count() == 4
    assert inference.annotate(items(spark), strict, "other model", responses=first)[1].count() == 4


def test_unusable_responses_are_asked_again(spark):
    _, stored = inference.annotate(items(spark, "abc"), answer, "m", store=lambda df: store_stage(df, "r"))
    damaged = stored.withColumn(
        "raw_text", F.when(F.col("image_id") == "a", '{"background": "sky"}').when(F.col("image_id") == "b", "junk").otherwise(F.col("raw_text"))
    )
    _, new = inference.annotate(items(spark, "abc"), answer, "m", responses=damaged)
    assert rows(new, "image_id") == [("b",)]


def test_the_newest_answer_counts(spark):
    _, first = inference.annotate(items(spark, "ab"), answer, "m", store=lambda df: store_stage(df, "r"))
    other = lambda batch: ['{"background": "building"}'] * len(batch)
    _, second = inference.annotate(items(spark, "a"), other, "m", responses=first, refresh=True, store=lambda df: store_stage(df, "r"))
    never = lambda batch: 1 / 0
    out, new = inference.annotate(items(spark, "ab"), never, "m", responses=first.unionByName(second))
    assert new.count() == 0 and dict(rows(out, "image_id", "background"))["a"] == "building"


def test_repeated_items_are_asked_once(spark):
    twice = items(spark, "a").union(items(spark, "a")).union(items(spark, "b"))
    out, new = inference.annotate(twice, answer, "m")
    assert new.count() == 2 and out.count() == 3


def forms(spark, *edits):
    names = schema.EDIT_FORM.fieldNames()
    return spark.createDataFrame([tuple(e.get(n, "") for n in names) for e in edits], schema.EDIT_FORM)


def test_edit_parsing(spark):
    form = forms(spark, {"image_id": "a", "possible_confusers": " bird ,, plane ", "score": "4", "drone_present": "TRUE", "lighting": "dark"},
                 {"image_id": "b", "possible_confusers": " , ", "score": "x1"})
    got = {r.image_id: r for r in curate.parse_edits(form).collect()}
    assert (got["a"].possible_confusers, got["a"].score, got["a"].drone_present, got["a"].lighting) == (["bird", "plane"], 4, True, "dark")
    assert (got["b"].possible_confusers, got["b"].score, got["b"].drone_present, got["b"].lighting) == (None, None, False, None)


def test_edits_fill_defaults_and_leave_others_alone(spark):
    df = spark.createDataFrame(
        [("a", "sky", "dark", ["bird"], "keep", "large"), ("a", "trees", "dark", None, "keep", None), ("b", "sky", None, ["bird"], "reject", None)],
        "image_id string, background string, lighting string, possible_confusers array<string>, curation_status string, drone_visibility string",
    )
    edit = curate.parse_edits(forms(spark, {"image_id": "a", "background": "building"}, {"image_id": "zz"}))
    got = rows(curate.apply_edits(df, edit))
    assert got == [
        ("a", "building", "unknown", ["none"], "keep", None),
        ("a", "building", "unknown", ["none"], "keep", None),
        ("b", "sky", None, ["bird"], "reject", None),
    ]
    assert rows(curate.unmatched_edits(df, edit)) == [("zz",)]


def test_two_edits_of_one_row(spark):
    df = items(spark, "ab").withColumn("background", F.lit("sky"))
    edits = curate.parse_edits(forms(spark, {"image_id": "a", "background": "one"}, {"image_id": "a", "background": "two"}))
    with pytest.raises(PySparkException, match="duplicate"):
        curate.apply_edits(df, edits).collect()
    latest = edits.withColumn("at", F.when(F.col("background") == "one", 2).otherwise(1))
    assert rows(curate.apply_edits(df, latest, last_by="at"), "image_id", "background") == [("a", "one"), ("b", "sky")]


def test_evaluation_edits_hit_one_result_and_update_it(spark):
    df = spark.createDataFrame(
        [("m1", "q", "a", True, "uncertain", 3, False, False), ("m2", "q", "a", True, "uncertain", 3, False, False)],
        "model string, query_id string, image_id string, is_positive boolean, graded_response string, score int, retrieved boolean, correct boolean",
    )
    edit = curate.parse_edits(forms(spark, {"image_id": "a", "graded_response": "definitely yes", "score": "5"})).withColumns(
        {"model": F.lit("m2"), "query_id": F.lit("q")}
    )
    got = rows(curate.apply_edits(df, edit, ("model", "query_id", "image_id")), "model", "graded_response", "score", "retrieved", "correct")
    assert got == [("m1", "uncertain", 3, False, False), ("m2", "definitely yes", 5, True, True)]


def golden(spark, ids="abc"):
    return items(spark, ids).withColumns(
        {
            "lighting": F.lit("normal"), "blur_bucket": F.lit("sharp"), "augmentation_type": F.lit("real"),
            "source_image_id": F.lit(None).cast("string"), "is_synthetic": F.lit(False), "blur_score": F.lit(9.0),
        }
    )


def test_blur_candidates(spark):
    out = augment.patch_labels(augment.blur_candidates(golden(spark), "/out/", 2))
    assert rows(out, "image_id", "image_path", "augmentation_type", "source_image_id", "is_synthetic", "blur_bucket", "blur_score") == [
        (f"{i}__blur", f"/out/{i}__blur.jpg", "gaussian_blur", i, True, "blurry", 9.0) for i in "ab"
    ]
    assert augment.blur_candidates(golden(spark), "/out").count() == 3
    assert augment.patch_labels(augment.blur_candidates(golden(spark).limit(0), "/out")).count() == 0


PROMPTS = {"fog": "p fog", "night": "p night"}


def contents(spark, same="ab"):
    data = [(f"/{i}.jpg", bytearray(b"same" if i in same else i.encode())) for i in "abc"]
    return spark.createDataFrame(data, "image_path string, content binary")


def test_variants_keep_failures_and_edit_copies_once(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def editor(batch):
        if len(batch) > 1:
            raise RuntimeError("one at a time")
        row = batch.iloc[0]
        (log / row["key"]).write_bytes(bytes(row["content"]))
        if row["prompt"] == "p night" and bytes(row["content"]) == b"c":
            raise RuntimeError("too dark")
        return ["ok"]

    out = augment.variant_candidates(golden(spark), editor, "/out", PROMPTS, contents=contents(spark))
    out = augment.patch_labels(out)
    got = {r.image_id: r for r in out.collect()}
    assert sorted(got) == sorted(f"{i}__openai_{p}" for i in "abc" for p in PROMPTS)
    bad = got["c__openai_night"]
    assert (bad.image_path, bad.augmentation_type, bad.is_synthetic, bad.openai_augment_status) == (None, "openai_image_failed", False, "failed: too dark")
    good = got["a__openai_fog"]
    assert (good.image_path, good.augmentation_type, good.source_image_id, good.augment_label) == ("/out/a__fog.jpg", "openai_image", "a", "fog")
    assert (good.lighting, good.blur_bucket, got["b__openai_night"].lighting, got["b__openai_night"].blur_bucket) == ("dark", "blurry", "dark", "sharp")
    assert len(list(log.iterdir())) == 4
    assert rows(augment.augment_success(out)) == [("fog", 3, 3), ("night", 2, 3), ("total", 5, 6)]
    pool = augment.extend_eval_set(golden(spark), augment.blur_candidates(golden(spark), "/o"), out)
    assert pool.count() == 3 + 3 + 5
    pairs = augment.lineage(out, golden(spark, "ab"))
    assert rows(pairs.where("augment_label = 'fog'"), "source_image_id", "source_path", "image_id") == [
        ("a", "/a.jpg", "a__openai_fog"), ("b", "/b.jpg", "b__openai_fog"), ("c", None, "c__openai_fog")
    ]


def test_cached_edits_are_not_repeated(spark):
    b64 = content_b64(F.col("content"))
    cache = contents(spark).select(cache_key(b64, F.lit("p fog")).alias("key"), F.lit("ok").alias("status")).distinct()

    def editor(batch):
        assert not (batch["prompt"] == "p fog").any()
        return ["failed: no"] * len(batch)

    out = augment.variant_candidates(golden(spark), editor, "/out", PROMPTS, cache, contents(spark), max_rows=2)
    assert rows(out, "image_id", "openai_augment_status") == [
        ("a__openai_fog", "ok"), ("a__openai_night", "failed: no"), ("b__openai_fog", "ok"), ("b__openai_night", "failed: no")
    ]


def test_missing_content_is_a_failed_variant(spark):
    few = contents(spark).where("image_path != '/b.jpg'")
    out = augment.variant_candidates(golden(spark), lambda b: ["ok"] * len(b), "/out", PROMPTS, contents=few)
    assert rows(out.where("not is_synthetic"), "image_id", "openai_augment_status") == [
        ("b__openai_fog", "failed: no content"), ("b__openai_night", "failed: no content")
    ]


def test_bucketed_answers_stay_where_they_are(spark, tmp_path):
    """A second run asks nothing again, and its plan shuffles the requests only, not the kept answers."""
    keep = lambda new: append_buckets(inference.parsed_answers(new), str(tmp_path), schema.ANSWERS, "request_key", 4)
    read = lambda: read_buckets(spark, str(tmp_path), schema.ANSWERS, "request_key", 4)
    assert read() is None
    _, first = inference.annotate(items(spark, "ab"), answer, "m", store=lambda df: store_stage(df, "r"))
    keep(first)
    never = lambda batch: ["nothing useful"] * len(batch)
    out, new = inference.annotate(items(spark), never, "m", answers=read())
    assert rows(new, "image_id") == [("c",), ("d",)]
    assert rows(out, "image_id", "background", "annotation_status") == [
        ("a", "sky", "ok"), ("b", "unknown", "ok"), ("c", "unknown", "no_object"), ("d", "unknown", "no_object"),
    ]
    # A later answer of the same request counts; files are added to the buckets.
    other = lambda batch: ['{"background": "building"}'] * len(batch)
    _, second = inference.annotate(items(spark, "a"), other, "m", answers=read(), refresh=True, store=lambda df: store_stage(df, "r"))
    keep(second)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out, new = inference.annotate(items(spark, "ab"), never, "m", answers=read())
        assert new.count() == 0
        assert rows(out, "image_id", "background") == [("a", "building"), ("b", "unknown")]
        plan = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*(0123456789)"))
    # The tree of operators comes first, then their details.
    lines = plan.split("\n\n")[0].splitlines()
    scans = [i for i, line in enumerate(lines) if "buckets_" in line and "Scan" in line]
    assert len(scans) == 2 and plan.count("Bucketed: true") == 2
    for i in scans:
        above, at = [], depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < at:
                above.append(line)
                at = depth(line)
                if "Join" in line:
                    break
        assert "Join" in above[-1] and not any("Exchange" in line for line in above)
