"""Scoring, metrics, summaries and matrices."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from goldquarry import fixed_values as fv
from goldquarry.operators import evaluate, inference, sampling
from goldquarry.schema import BOXES

RESULT = "model string, query_id string, query_text string, image_id string, is_positive boolean, retrieved boolean"


def results(spark, *cells):
    """cells: (model, query, positive, retrieved, how often)"""
    data = []
    for m, q, p, r, n in cells:
        data += [(m, q, f"text {q}", f"{m}{q}{p}{r}{i}", p, r) for i in range(n)]
    return spark.createDataFrame(data, RESULT)


def planned(df):
    return df.select("query_id", "query_text", "image_id", "is_positive")


def test_metrics_and_zero_denominators(spark):
    df = results(spark, ("m", "a", True, True, 2), ("m", "a", False, True, 1), ("m", "a", True, False, 1),
                 ("m", "b", True, False, 2), ("m", "b", False, False, 3))
    got = {r.query_id: r for r in evaluate.query_metrics(df, planned(df), ["m"]).collect()}
    assert (got["a"].tp, got["a"].fp, got["a"].fn, got["a"].tn) == (2, 1, 1, 0)
    assert (got["a"].precision, got["a"].recall, got["a"].f1) == (0.6667, 0.6667, 0.6667)
    assert (got["b"].precision, got["b"].recall, got["b"].f1) == (0.0, 0.0, 0.0)
    assert (got["b"].n_positive, got["b"].n_negative) == (2, 3)


def test_planned_sizes_survive_skipped_frames(spark):
    full = results(spark, ("m", "a", True, True, 3), ("m", "a", False, False, 2), ("m", "b", True, True, 1))
    some = full.where("query_id = 'a' and image_id not like '%0'")
    got = {r.query_id: r for r in evaluate.query_metrics(some, planned(full), ["m"]).collect()}
    assert (got["a"].n_positive, got["a"].tp, got["a"].n_negative, got["a"].tn) == (3, 2, 2, 1)
    assert (got["b"].n_positive, got["b"].tp, got["b"].precision) == (1, 0, 0.0)


def test_summary_averages_rounded_values(spark):
    df = results(spark, ("m", "a", True, True, 1), ("m", "a", False, True, 2), ("m", "b", True, True, 1), ("m", "b", False, True, 5))
    row = evaluate.run_summary(evaluate.query_metrics(df, planned(df), ["m"])).first()
    assert (row.n_queries, row.retrieval_threshold) == (2, 4)
    assert row.mean_precision == round((0.3333 + 0.1667) / 2, 4)
    assert [q.query_id for q in row.per_query] == ["a", "b"]


def test_support_of_four_and_five(spark):
    df = results(spark, ("m", "a", True, True, 4), ("m", "b", True, True, 5)).withColumn("condition", F.col("query_id"))
    got = {r.condition: (r.n, r.precision) for r in evaluate.metrics_by(df, ["model", "condition"], min_support=5).collect()}
    assert got == {"a": (4, None), "b": (5, 1.0)}


def test_null_keys_are_left_out(spark):
    df = results(spark, ("m", "a", True, True, 1)).withColumn("query_text", F.lit(None).cast("string"))
    assert evaluate.metrics_by(df, ["model", "query_text"]).count() == 0


def test_matrix_mean_skips_nulls(spark):
    metrics = spark.createDataFrame(
        [("m1", "a", 1.0, 0.5, 0.2), ("m1", "b", None, None, None), ("m2", "a", 0.0, 0.0, 0.0), ("m2", "b", 1.0, 1.0, 1.0)],
        "model string, condition string, precision double, recall double, f1 double",
    )
    matrix = evaluate.metric_matrix(metrics, "condition", ["m1", "m2", "m3"])
    assert matrix.columns[:4] == ["condition", "m1 precision", "m2 precision", "m3 precision"]
    got = {r.condition: (r["m1 precision"], r["m2 precision"], r["m3 f1"]) for r in matrix.collect()}
    assert got == {"a": (1.0, 0.0, None), "b": (None, 1.0, None), "mean": (1.0, 0.5, None)}


def test_conditions(spark):
    df = spark.createDataFrame(
        [("fog", "openai_image"), (None, "gaussian_blur"), (None, "real"), (None, None), ("x", "gaussian_blur")],
        "augment_label string, augmentation_type string",
    )
    assert [r.condition for r in evaluate.with_condition(df).collect()] == ["fog", "blur", "original", "original", "x"]
    assert evaluate.with_condition(df.select(F.lit(1))).first().condition == "original"


def queries(spark):
    return spark.createDataFrame(
        [("q1", "t1", "a", True), ("q1", "t1", "b", False), ("q2", "t2", "a", False), ("q2", "t2", "gone", True)],
        "query_id string, query_text string, image_id string, is_positive boolean",
    )


def items(spark):
    return spark.createDataFrame(
        [("a", "/a.jpg", "sky"), ("b", "/b.jpg", "trees"), ("c", "/c.jpg", "sky")], "image_id string, image_path string, background string"
    )


def fussy(batch):
    """Fails for one frame, which must not cost the others their answers."""
    if (batch["image_id"] == "b").any():
        raise RuntimeError("refused")
    return ["definitely yes" if "t1" in p else "no idea" for p in batch["prompt"]]


def test_failed_calls_count_as_uncertain(spark):
    out = inference.score_frames(queries(spark), items(spark), fussy, ["m1", "m2"], max_rows=4)
    got = rows(out.where("model = 'm1'"), "query_id", "image_id", "graded_response", "score", "retrieved", "correct", "error")
    assert got == [
        ("q1", "a", "definitely yes", 5, True, True, None),
        ("q1", "b", "uncertain", 3, False, True, "refused"),
        ("q2", "a", "uncertain", 3, False, True, None),
    ]
    assert out.count() == 6
    assert rows(inference.skipped_frames(queries(spark), items(spark)), "query_id", "image_id") == [("q2", "gone")]


def test_listing_and_repeated_items(spark):
    listing = items(spark).select("image_path").where("image_path != '/b.jpg'")
    twice = items(spark).union(spark.createDataFrame([("a", "/a0.jpg", "sky")], items(spark).schema))
    out = inference.score_frames(queries(spark), twice, lambda b: list(b["image_path"]), ["m"], listing=listing)
    assert rows(out, "query_id", "image_id", "raw_response") == [("q1", "a", "/a.jpg"), ("q2", "a", "/a.jpg")]
    assert inference.skipped_frames(queries(spark), items(spark), listing).count() == 2


def test_detailed_eval_falls_back_to_the_query_id(spark):
    out = inference.score_frames(queries(spark), items(spark), fussy, ["m"])
    known = queries(spark).where("query_id = 'q1'")
    detail = evaluate.detailed_eval(out, known, items(spark))
    assert detail.columns == ["model", "query_id", "query_text", "image_id", "is_positive", "graded_response", "score",
                              "retrieved", "correct", "background"]
    assert rows(detail, "query_text", "image_id", "background") == [("q2", "a", "sky"), ("t1", "a", "sky"), ("t1", "b", "trees")]


def test_confusion_counts_cover_all_rows(spark):
    df = results(spark, ("m", "a", True, True, 3), ("m", "a", False, True, 2), ("m", "a", True, False, 4), ("m", "a", False, False, 1))
    row = evaluate.query_metrics(df, planned(df), ["m"]).first()
    assert row.tp + row.fp + row.fn + row.tn == df.count()


def test_scoring_does_not_shuffle_the_items(spark, tmp_path):
    items(spark).write.parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    out = inference.score_frames(queries(spark), stored, fussy, ["m"], max_rows=sampling.query_set_bound(1, 2))
    text = out._sc._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "simple")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "background" not in text


def test_unknown_annotators_are_refused(spark):
    with pytest.raises(ValueError):
        inference.annotate(items(spark), fussy, "m", annotator="nobody")


def test_content_reaches_the_responder_once_per_frame(spark):
    images = spark.createDataFrame([("/a.jpg", b"A"), ("/zz.jpg", b"Z")], "image_path string, content binary")
    out = inference.score_frames(
        queries(spark), items(spark), lambda b: [bytes(c).decode() + " probably yes" for c in b["content"]], ["m"], images, max_rows=4
    )
    assert rows(out, "query_id", "image_id", "raw_response", "score") == [("q1", "a", "A probably yes", 4), ("q2", "a", "A probably yes", 4)]
    assert "content" not in out.columns


def test_requests_carry_the_response_schema(spark):
    import json

    schema = json.loads(inference.response_schema())
    assert set(schema["properties"]) == set(schema["required"]) == {*fv.ENUM_DEFAULTS, "possible_confusers", "caption"}
    assert "unknown" not in schema["properties"]["camera_angle"]["enum"]
    assert schema["properties"]["possible_confusers"]["items"]["enum"] == fv.CONFUSERS
    wanted = inference.response_schema()

    def responder(batch):
        assert set(batch["response_schema"]) <= {wanted}
        return ['{"background": "sky"}'] * len(batch)

    items = spark.createDataFrame(
        [("a", "/a.jpg", True, 1, 10, 10)], "image_id string, image_path string, drone_present boolean, box_count int, width int, height int"
    ).withColumn("bbox", F.array().cast(BOXES))
    done, new = inference.annotate(items, responder, "m")
    assert done.first().background == "sky" and new.first().error is None
