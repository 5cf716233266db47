"""All phases end to end over a folder of generated images."""

import pytest
from helpers import png, rows

from goldquarry.params import JobParams
from goldquarry.plans import workflow
from goldquarry.plans.responders import edit_by_digest, grade_by_digest
from goldquarry import schema
from goldquarry.sources.artifacts import catalogue, load_dataset
from goldquarry.sources.images import list_images, read_contents, read_images


def answer(batch):
    lighting = ["normal", "dark"]
    return [
        '{"background": "sky", "lighting": "%s", "blur_bucket": "sharp", "possible_confusers": ["none"], '
        '"camera_angle": "%s", "depth_range": "landscape", "caption": "x"}'
        % (lighting[hash_of(i) % 2], "top_down" if i == "p0" else "eye_level")
        for i in batch["image_id"]
    ]


def hash_of(text):
    return sum(map(ord, text))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("images")
    (root / "test" / "x").mkdir(parents=True)
    box = "<object><bndbox><xmin>0</xmin><ymin>0</ymin><xmax>3</xmax><ymax>3</ymax></bndbox></object>"
    size = "<size><width>12</width><height>12</height></size>"
    for i in range(8):
        for kind in "pn":
            checker = lambda x, y: (40 + 20 * i + 60 * ((x + y) % 2),) * 3
            (root / "test" / "x" / f"{kind}{i}.png").write_bytes(png(12, 12, checker))
        (root / "test" / "x" / f"p{i}.xml").write_text(f"<annotation>{size}{box}</annotation>")
    return root


def test_phases(spark, folder, tmp_path):
    root = str(tmp_path / "artifacts")
    params = JobParams(artifact_dir=root, models=("m1", "m2"), n_samples=2, coverage_min_count=3)
    paths = {"test": str(folder / "test"), "train": str(folder / "train")}
    with pytest.raises(ValueError, match="raw was not stored"):
        workflow.curate(spark, answer, params)
    raw = workflow.ingest(spark, paths, params)
    assert raw.count() == 16 and raw.where("drone_present").count() == 8

    curated = workflow.curate(spark, answer, params)
    assert curated.count() == 16 and curated.where("drone_visibility = 'large'").count() == 8

    def fail(batch):
        raise AssertionError("asked again")

    again = workflow.curate(spark, fail, params)
    assert rows(again.drop("raw")) == rows(curated.drop("raw"))

    out = workflow.select_golden(spark, read_images(spark, paths["test"]), params)
    counts = out["counts"].first()
    assert (counts.kept + counts.dropped, counts.total) == (16, 16)
    assert out["golden"].count() == counts.kept and out["golden"].where("image_id = 'p0'").count() == 0
    assert {r.stat for r in out["statistics"].collect()} == {"blur_score", "brightness", "bbox_ratio"}
    assert out["histograms"].where("stat = 'bbox_ratio'").count() == 30

    report = workflow.report_coverage(spark, params)
    assert report["coverage"].where("dimension = 'drone_present'").count() == 2

    candidates = workflow.augment_golden(spark, edit_by_digest, params, read_contents(spark, paths["test"]))
    positives = out["golden"].where("drone_present").count()
    assert candidates.count() == positives * 7

    result = workflow.evaluate_models(spark, grade_by_digest, params)
    metrics = result["metrics"].collect()
    assert metrics and all(m.n_positive == m.n_negative == 2 for m in metrics)
    assert all(m.tp + m.fn == 2 and m.fp + m.tn == 2 for m in metrics)
    assert {r.model for r in result["summary"].collect()} == {"m1", "m2"}
    stored = workflow.evaluation_matrices(spark, params)
    for name, index in (("by_query", "query_text"), ("by_condition", "condition")):
        assert rows(stored[name]) == rows(result[name])
        assert stored[name].where(f"{index} = 'mean'").count() == 1
    status = {r.name: (r.available, r.rows) for r in catalogue(spark, root).collect()}
    assert all(ok for ok, _ in status.values()) and status["eval"][1] == 4 * len(metrics)


    form = {f.name: "" for f in schema.EDIT_FORM.fields}
    forms = spark.createDataFrame(
        [tuple({**form, "image_id": i, "curation_status": "reject"}.values()) for i in ("n1", "nobody")], schema.EDIT_FORM
    )
    assert rows(workflow.edit_dataset(spark, "golden", forms, params)) == [("nobody",)]
    edited = load_dataset(spark, root, "golden")
    assert rows(edited.where("curation_status = 'reject'"), "image_id", "background") == [("n1", "unknown")]
    assert edited.count() == counts.kept and out["golden"].where("curation_status = 'reject'").count() == 0
    with pytest.raises(ValueError):
        workflow.edit_dataset(spark, "raw", forms, params)


def test_custom_query_set_and_listing(spark, folder, tmp_path):
    root = str(tmp_path / "artifacts")
    params = JobParams(artifact_dir=root, models=("m1",), max_curation_rows=5, ranges={}, exclusions={})
    paths = {"test": str(folder / "test")}
    workflow.ingest(spark, paths, params)
    curated = workflow.curate(spark, answer, params)
    assert curated.where("drone_present").count() == 3 and curated.count() == 5
    workflow.select_golden(spark, read_images(spark, paths["test"]), params)
    workflow.augment_golden(spark, edit_by_digest, params)
    some = curated.limit(2).selectExpr("'mine' as query_id", "'my query' as query_text", "image_id", "true as is_positive")
    listing = list_images(spark, paths["test"])
    result = workflow.evaluate_models(spark, grade_by_digest, params, listing=listing, query_set=some)
    row = result["metrics"].first()
    assert (row.query_id, row.n_positive, row.n_negative, row.tp + row.fn) == ("mine", 2, 0, 2)


def test_blurred_pictures_exist_and_are_scored(spark, folder, tmp_path):
    root = str(tmp_path / "artifacts")
    params = JobParams(artifact_dir=root, models=("m1",), ranges={}, exclusions={})
    paths = {"test": str(folder / "test")}
    workflow.ingest(spark, paths, params)
    workflow.curate(spark, answer, params)
    pixels = read_images(spark, paths["test"])
    workflow.select_golden(spark, pixels, params)
    without_p0 = pixels.where("NOT image_path LIKE '%/p0.png'")
    candidates = workflow.augment_golden(spark, edit_by_digest, params, images=without_p0)
    blur = {r.source_image_id: r.is_synthetic for r in candidates.where("augmentation_type = 'gaussian_blur'").collect()}
    assert blur == {f"p{i}": i != 0 for i in range(8)}
    some = candidates.where("augmentation_type = 'gaussian_blur'").selectExpr("'q' as query_id", "'t' as query_text", "image_id", "true as is_positive")

    def look(batch):
        assert "is_positive" not in batch.columns
        return ["definitely yes" if c[:4] == b"\x89PNG" else "definitely no" for c in batch["content"]]

    result = workflow.evaluate_models(spark, look, params, images=read_contents(spark, paths["test"]), query_set=some)
    assert result["metrics"].first().tp == 7

    def never(batch):
        assert not len(batch) or all(k[0] in "048c" for k in batch["key"])
        return edit_by_digest(batch)

    again = workflow.augment_golden(spark, never, params, images=without_p0)
    assert again.count() == candidates.count()
