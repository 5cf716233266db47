"""The phases from image folders to evaluation reports, each storing its artifact.

Every phase reads the stored artifact of the one before, so a phase can be repeated on its own
and a lost executor never causes model calls to be made again.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from goldquarry import fixed_values as fv
from goldquarry.operators import augment, coverage, curate as edits, evaluate, inference, sampling
from goldquarry.operators.joins import check_unique
from goldquarry.operators.pixels import blurred_files, image_stats
from goldquarry.operators.quality import describe, histogram, kept_dropped, quality_filter, quality_predicate
from goldquarry.params import JobParams
from goldquarry.schema import ANSWERS, CURATED, GOLDEN, RESPONSES
from goldquarry.sources.artifacts import export_coverage, load_dataset, write_dataset, write_run
from goldquarry.sources.buckets import append_buckets, read_buckets
from goldquarry.sources.items import load_quarantine, load_splits
from goldquarry.sources.paths import path_exists
from goldquarry.sources.stages import store_stage

STATISTICS = ["blur_score", "brightness", "bbox_ratio"]


def _in_schema(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _stored(spark: SparkSession, params: JobParams, name: str) -> DataFrame:
    df = load_dataset(spark, params.artifact_dir, name)
    if df is None:
        raise ValueError(f"{name} was not stored below {params.artifact_dir} yet")
    return df


def ingest(spark: SparkSession, paths: dict[str, str], params: JobParams) -> DataFrame:
    """Image folders and sidecars -> raw items; broken files go to the folder `quarantine`.

    An id that names several images stops the job before anything is paid for.
    """
    load_quarantine(spark, paths).write.mode("overwrite").parquet(f"{params.artifact_dir}/quarantine")
    items = store_stage(load_splits(spark, paths), "items")
    repeated = [r["image_id"] for r in check_unique(items, "image_id").limit(5).collect()]
    if repeated:
        raise ValueError(f"image ids that name several images, such as {', '.join(map(str, repeated))}")
    write_dataset(items, params.artifact_dir, "raw")
    return _stored(spark, params, "raw")


def curate(
    spark: SparkSession,
    responder: Callable,
    params: JobParams,
    images: DataFrame | None = None,
    parallelism: int | None = None,
) -> DataFrame:
    """Raw items -> curated items. Responses are kept and reused by the next run."""
    items = sampling.balanced_sample(
        _stored(spark, params, "raw"), "drone_present", params.max_curation_rows, seed=params.seed
    )
    kept = f"{params.artifact_dir}/{params.annotator}_responses"
    by_key = f"{params.artifact_dir}/{params.annotator}_answers"
    answers = read_buckets(spark, by_key, ANSWERS, "request_key", params.answer_buckets)
    if answers is None and path_exists(spark, kept):
        # Responses of earlier runs are parsed and put into buckets once.
        earlier = inference.parsed_answers(spark.read.schema(RESPONSES).parquet(kept))
        append_buckets(earlier, by_key, ANSWERS, "request_key", params.answer_buckets)
        answers = read_buckets(spark, by_key, ANSWERS, "request_key", params.answer_buckets)
    annotated, new = inference.annotate(
        items,
        responder,
        params.annotation_model,
        params.annotator,
        None,
        images,
        refresh=params.force_refresh,
        parallelism=parallelism,
        store=lambda df: store_stage(df, "responses"),
        answers=answers,
    )
    # Paid answers are kept before anything else can fail.
    new.where(F.col("error").isNull()).write.mode("append").parquet(kept)
    append_buckets(inference.parsed_answers(new), by_key, ANSWERS, "request_key", params.answer_buckets)
    write_dataset(_in_schema(annotated, CURATED), params.artifact_dir, "curated")
    return _stored(spark, params, "curated")


def select_golden(spark: SparkSession, images: DataFrame, params: JobParams) -> dict[str, DataFrame]:
    """Curated items and pixels -> golden set, kept / dropped counts and statistics."""
    items = store_stage(image_stats(_stored(spark, params, "curated"), images), "statistics")
    golden = quality_filter(items, params.ranges, params.exclusions)
    write_dataset(_in_schema(golden, GOLDEN), params.artifact_dir, "golden")
    predicate = quality_predicate(items.columns, params.ranges, params.exclusions)
    ratio_of_present = F.when(F.col("drone_present"), F.col("bbox_ratio"))
    return {
        "golden": _stored(spark, params, "golden"),
        "counts": kept_dropped(items, predicate),
        "statistics": describe(items, STATISTICS),
        "histograms": histogram(
            items, {**{c: F.col(c) for c in STATISTICS}, "bbox_ratio": ratio_of_present}
        ),
    }


def report_coverage(spark: SparkSession, params: JobParams) -> dict[str, DataFrame]:
    """Golden set -> coverage, gaps and cross-tabs, exported as CSV."""
    golden = _stored(spark, params, "golden")
    table = store_stage(coverage.coverage(golden, min_count=params.coverage_min_count), "coverage")
    found = coverage.gaps(table, params.coverage_min_count)
    tabs = store_stage(coverage.crosstabs(golden), "crosstabs")
    export_coverage(table, found, tabs, params.artifact_dir)
    return {"coverage": table, "gaps": found, "crosstabs": tabs}


def augment_golden(
    spark: SparkSession,
    editor: Callable,
    params: JobParams,
    contents: DataFrame | None = None,
    parallelism: int | None = None,
    images: DataFrame | None = None,
) -> DataFrame:
    """Golden positives -> candidates with lineage. Successful edits are kept and reused by the next run.

    With `images` (image_path, image) the blurred pictures are made and stored as rows (image_path,
    content) that `evaluate_models` reads next to the images; a blurred candidate is synthetic only if
    its picture was stored. Without them the pictures are taken to lie at the candidates' paths.
    """
    kept = f"{params.artifact_dir}/edits"
    cache = spark.read.schema("key string, status string").parquet(kept) if path_exists(spark, kept) else None
    targets = augment.positives(_stored(spark, params, "golden"))
    out = f"{params.artifact_dir}/augmented"
    blur = augment.blur_candidates(targets, f"{out}/blur", params.max_augmentation_rows)
    if images is not None:
        blur = _with_blurred_pictures(spark, targets, blur, images, params)
    variants = augment.variant_candidates(
        targets,
        editor,
        f"{out}/weather",
        cache=cache,
        contents=contents,
        max_rows=params.max_augmentation_rows,
        parallelism=parallelism,
        store=lambda df: store_stage(df, "variants"),
        keep=lambda new: new.where("status = 'ok'").write.mode("append").parquet(kept),
    )
    candidates = augment.candidate_union(augment.patch_labels(blur), augment.patch_labels(variants))
    write_dataset(candidates, params.artifact_dir, "augmented")
    return _stored(spark, params, "augmented")


def _blurred(spark: SparkSession, params: JobParams) -> DataFrame | None:
    """Stored blurred pictures (image_path, content)."""
    path = f"{params.artifact_dir}/blurred"
    return spark.read.schema("image_path string, content binary").parquet(path) if path_exists(spark, path) else None


def _with_blurred_pictures(spark, targets: DataFrame, blur: DataFrame, images: DataFrame, params: JobParams) -> DataFrame:
    wanted = blur.select(F.col("source_image_id").alias("image_id"), F.col("image_path").alias("_variant")).join(
        targets.select("image_id", "image_path"), "image_id"
    )
    # The pixels of the wanted images are blurred where they lie, and written.
    sources = images.join(wanted.select("image_path", "_variant"), "image_path")
    pictures = blurred_files(sources.select(F.col("_variant").alias("image_path"), "image"))
    pictures.write.mode("overwrite").parquet(f"{params.artifact_dir}/blurred")
    return augment.with_pictures(blur, _blurred(spark, params))


def evaluate_models(
    spark: SparkSession,
    responder: Callable,
    params: JobParams,
    images: DataFrame | None = None,
    listing: DataFrame | None = None,
    query_set: DataFrame | None = None,
    parallelism: int | None = None,
) -> dict[str, DataFrame]:
    """Golden set and candidates -> scored frames, metrics, summaries and matrices.

    A custom `query_set` (query_id, query_text, image_id, is_positive) replaces the built one.
    """
    models, root = list(params.models), params.artifact_dir
    pool = augment.extend_eval_set(_stored(spark, params, "golden"), _stored(spark, params, "augmented"))
    if params.max_eval_rows:
        pool = store_stage(
            sampling.balanced_sample(pool, "drone_present", params.max_eval_rows, seed=params.seed), "pool"
        )
    bound = None
    if query_set is None:
        query_set = sampling.build_query_set(
            pool, n_queries=params.n_queries, n_samples=params.n_samples, seed=params.seed
        )
        bound = sampling.query_set_bound(params.n_queries, params.n_samples)
    query_set = store_stage(query_set, "query_set")
    made = _blurred(spark, params)
    if made is not None:
        images = None if images is None else images.select("image_path", "content").unionByName(made)
        listing = None if listing is None else listing.select("image_path").unionByName(made.select("image_path"))
    results = inference.score_frames(
        query_set,
        pool,
        responder,
        models,
        images,
        listing,
        bound,
        parallelism,
        store=lambda df: store_stage(df, "answers"),
    )
    metrics = evaluate.query_metrics(results, query_set, models)
    summary = evaluate.run_summary(metrics)
    write_run(results, summary, root)
    detailed = evaluate.detailed_eval(
        results, query_set, pool, max_rows=None if bound is None else bound * len(models)
    )
    write_dataset(detailed, root, "eval")
    return {"metrics": metrics, "summary": summary, **evaluation_matrices(spark, params)}


def evaluation_matrices(spark: SparkSession, params: JobParams) -> dict[str, DataFrame]:
    """Matrices by query and by condition, from the stored evaluation; no calls are made."""
    models = list(params.models)
    detailed = evaluate.with_condition(_stored(spark, params, "eval"))
    by_query = evaluate.metrics_by(detailed, ["model", "query_text"])
    by_condition = evaluate.metrics_by(
        detailed, ["model", "condition"], min_support=fv.CONDITION_MIN_SUPPORT
    )
    return {
        "by_query": evaluate.metric_matrix(by_query, "query_text", models),
        "by_condition": evaluate.metric_matrix(by_condition, "condition", models),
    }


def edit_dataset(
    spark: SparkSession, name: str, forms: DataFrame, params: JobParams, last_by: str | None = None
) -> DataFrame:
    """Store a new version of an artifact with label edits; returns the edits that name no row.

    Forms hold string fields; for the evaluation they also name model and query_id.
    """
    if name == "raw":
        raise ValueError("the raw dataset is read-only")
    df = _stored(spark, params, name)
    keys = ("model", "query_id", "image_id") if name == "eval" else ("image_id",)
    parsed = edits.parse_edits(forms)
    write_dataset(edits.apply_edits(df, parsed, keys, last_by), params.artifact_dir, name)
    return edits.unmatched_edits(df, parsed, keys)
