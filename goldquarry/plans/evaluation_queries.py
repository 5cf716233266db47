"""Catalogue queries: samples, query sets, model jobs, metrics and matrices."""

from pyspark.sql import functions as F

from goldquarry import fixed_values as fv
from goldquarry.operators import evaluate, inference, sampling
from goldquarry.plans import frames as fr
from goldquarry.plans import oracle_views as ov
from goldquarry.plans.augmentation_queries import CANDIDATES, extended
from goldquarry.plans.registry import query
from goldquarry.plans.responders import annotate_by_digest, grade_by_digest
from goldquarry.sources.stages import store_stage

MODELS = ["model-a", "model-b"]
N_QUERIES = 20


@query(
    "balanced_sample",
    f"""WITH {ov.FRAMES}, sizes AS (
      SELECT count(*) FILTER (drone_present) AS pos, count(*) FILTER (NOT drone_present) AS neg FROM frames
    ),
    quota AS (SELECT least(pos, greatest(51, 101 - neg)) AS pos_n, neg FROM sizes),
    ranked AS (
      SELECT image_id, drone_present, row_number() OVER (PARTITION BY drone_present
             ORDER BY md5('42|' || image_id), image_id) AS rn
      FROM frames WHERE drone_present IS NOT NULL
    )
    SELECT image_id, drone_present FROM ranked, quota
    WHERE rn <= CASE WHEN drone_present THEN pos_n ELSE least(neg, 101 - pos_n) END""",
)
def balanced_sample(spark, sf):
    return sampling.balanced_sample(fr.frames(spark, sf), "drone_present", 101).select("image_id", "drone_present")


@query(
    "balanced_sample_large",
    """WITH lines AS (
      SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_id,
             CASE l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS returned FROM lineitem
    ),
    sizes AS (SELECT count(*) FILTER (returned) AS pos, count(*) FILTER (NOT returned) AS neg FROM lines),
    quota AS (SELECT least(pos, greatest(1501, 3001 - neg)) AS pos_n, neg FROM sizes),
    ranked AS (
      SELECT line_id, returned, row_number() OVER (PARTITION BY returned
             ORDER BY md5('42|' || line_id), line_id) AS rn
      FROM lines WHERE returned IS NOT NULL
    )
    SELECT line_id, returned FROM ranked, quota
    WHERE rn <= CASE WHEN returned THEN pos_n ELSE least(neg, 3001 - pos_n) END""",
)
def balanced_sample_large(spark, sf):
    """A sample too large to be ranked in one task per class."""
    lines = fr.table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line_id"),
        F.when(F.col("l_returnflag") == "R", True).when(F.col("l_returnflag") == "A", False).alias("returned"),
    )
    return sampling.balanced_sample(lines, "returned", 3001, key="line_id")


FRAME_SET = ov.query_set("frames", N_QUERIES, fv.QUERY_SAMPLES)


@query(
    "template_eligibility",
    f"""WITH {ov.FRAMES}, {ov.query_set("frames", 4, 40)}
    SELECT CAST(position AS INTEGER) AS position, query_id, query_text, n_positive, n_negative, eligible,
           query_id IN (SELECT query_id FROM chosen) AS chosen FROM eligible""",
)
def template_eligibility(spark, sf):
    return sampling.template_eligibility(fr.frames(spark, sf), n_queries=4, n_samples=40)


@query("query_set", f"WITH {ov.FRAMES}, {FRAME_SET} SELECT * FROM query_set")
def query_set(spark, sf):
    return sampling.build_query_set(fr.frames(spark, sf), n_queries=N_QUERIES)


@query(
    "query_set_nested",
    f"""WITH {ov.FRAMES}, {FRAME_SET},
    lists AS (
      SELECT query_id, query_text, array_to_string(list_sort(list(image_id) FILTER (is_positive)), ',') AS positive_ids,
             array_to_string(list_sort(list(image_id) FILTER (NOT is_positive)), ',') AS negative_ids
      FROM query_set GROUP BY ALL
    )
    SELECT *, positive_ids || ',' || negative_ids AS all_ids FROM lists""",
)
def query_set_nested(spark, sf):
    nested = sampling.query_set_nested(sampling.build_query_set(fr.frames(spark, sf), n_queries=N_QUERIES))
    lists = ("positive_ids", "negative_ids", "all_ids")
    return nested.select("query_id", "query_text", *[F.array_join(c, ",").alias(c) for c in lists])


@query(
    "eval_plan_size",
    f"""WITH {ov.FRAMES}, {FRAME_SET}
    SELECT CAST(2 AS BIGINT) AS n_models, count(DISTINCT query_id) AS n_queries, count(*) AS n_frames,
           2 * count(*) AS n_calls FROM query_set""",
)
def eval_plan_size(spark, sf):
    return sampling.eval_plan(sampling.build_query_set(fr.frames(spark, sf), n_queries=N_QUERIES), MODELS)


DIGIT = "substr(md5(image_id), 1, 1)"
ANSWERED_SQL = f"""
answered AS (
  SELECT *, CASE WHEN toxic = 0 THEN 'cached'
                 WHEN {DIGIT} IN ('0','1','2','3') THEN 'clean' WHEN {DIGIT} IN ('4','5','6','7') THEN 'fenced'
                 WHEN {DIGIT} IN ('8','9','a','b') THEN 'thought' ELSE 'none' END AS answer
  FROM frames
)"""


@query(
    "annotate_job",
    f"""WITH {ov.FRAMES}, {ANSWERED_SQL}
    SELECT image_id,
      CASE answer WHEN 'cached' THEN 'trees' WHEN 'clean' THEN 'sky' WHEN 'thought' THEN 'building' ELSE 'unknown' END AS background,
      CASE answer WHEN 'clean' THEN 'dark' ELSE 'unknown' END AS lighting,
      CASE answer WHEN 'cached' THEN 'mild' WHEN 'clean' THEN 'blurry' WHEN 'thought' THEN 'mild' ELSE 'sharp' END AS blur_bucket,
      CASE answer WHEN 'cached' THEN 'helicopter' WHEN 'clean' THEN 'bird' WHEN 'thought' THEN 'aircraft' ELSE 'none' END AS possible_confusers,
      CASE answer WHEN 'clean' THEN 'eye_level' ELSE 'unknown' END AS camera_angle,
      CASE answer WHEN 'clean' THEN 'landscape' WHEN 'fenced' THEN 'mid_range' ELSE 'unknown' END AS depth_range,
      drone_visibility, 'gemini' AS annotator,
      CASE answer WHEN 'clean' THEN 'item ' || image_id ELSE '' END AS caption,
      CASE answer WHEN 'none' THEN 'no_object' ELSE 'ok' END AS annotation_status,
      CASE WHEN answer IN ('cached', 'clean', 'thought') THEN 'needs_review' ELSE 'keep' END AS curation_status
    FROM answered""",
)
def annotate_job(spark, sf):
    """Annotation of all items; labelled ones have a stored response, usable unless toxic."""
    items = fr.frames(spark, sf)
    bare = items.select(
        "image_id", "image_path", "width", "height", "drone_present", "bbox", "box_count", "source_split"
    )
    prompt = inference.curation_prompt(F.col("image_id"), F.col("drone_present"), F.col("box_count"))
    usable = '{"background": "trees", "blur_bucket": "mild", "possible_confusers": ["helicopter"]}'
    stored = items.where(F.col("toxic").isNotNull()).select(
        inference.request_key(F.col("image_id"), "model-a", prompt, fv.SCHEMA_VERSION).alias("request_key"),
        "image_id",
        F.lit("model-a").alias("model"),
        F.lit(fv.SCHEMA_VERSION).alias("schema_version"),
        F.when(F.col("toxic") == 0, usable).otherwise("no object here").alias("raw_text"),
        F.lit(None).cast("string").alias("error"),
    )
    annotated, _ = inference.annotate(bare, annotate_by_digest, "model-a", responses=stored)
    return annotated.select(
        "image_id", "background", "lighting", "blur_bucket",
        F.array_join("possible_confusers", ",").alias("possible_confusers"),
        "camera_angle", "depth_range", "drone_visibility", "annotator", "raw.caption",
        "annotation_status", "curation_status",
    )


@query(
    "annotate_refreshed",
    f"""WITH {ov.FRAMES}
    SELECT image_id, 'building' AS background, 'sharp' AS blur_bucket, 'ok' AS annotation_status FROM frames""",
)
def annotate_refreshed(spark, sf):
    """Two stored answers per item, the newer one sorting first and without most fields; nothing is asked."""
    items = fr.frames(spark, sf).select(
        "image_id", "image_path", "width", "height", "drone_present", "bbox", "box_count", "source_split"
    )
    prompt = inference.curation_prompt(F.col("image_id"), F.col("drone_present"), F.col("box_count"))
    key = inference.request_key(F.col("image_id"), "model-a", prompt, fv.SCHEMA_VERSION)
    answers = [("trees", "2024-01-01"), ("building", "2024-01-02")]
    stored = items.select(key.alias("request_key"), "image_id", F.explode(F.array(*[
        F.struct(F.lit(f'{{"background": "{b}"}}').alias("raw_text"), F.lit(day).cast("timestamp").alias("answered_at"))
        for b, day in answers
    ])).alias("a")).select("request_key", "image_id", F.lit(None).cast("string").alias("error"), "a.*")
    annotated, _ = inference.annotate(items, annotate_by_digest, "model-a", responses=stored)
    return annotated.select("image_id", "background", "blur_bucket", "annotation_status")


def scored(pool):
    """(query set, results) of both models over a pool of items; query set and answers are stored."""
    chosen = store_stage(sampling.build_query_set(pool, n_queries=N_QUERIES), "query_set")
    results = inference.score_frames(
        chosen,
        pool,
        grade_by_digest,
        MODELS,
        max_rows=sampling.query_set_bound(N_QUERIES),
        store=lambda raw: store_stage(raw, "answers"),
    )
    return chosen, results


def stored_extended(spark, sf):
    return store_stage(extended(spark, sf), "extended")


def _scores_sql(source: str) -> str:
    digit = "substr(md5(model || '|' || query_id || '|' || image_id), 1, 1)"
    return f"""
    {ov.query_set(source, N_QUERIES, fv.QUERY_SAMPLES)},
    graded AS (
      SELECT model, query_id, query_text, image_id, is_positive,
        CASE WHEN {digit} IN ('0','1','2','3','4','5','6','7')
               THEN CASE WHEN substr(md5(image_id || '|' || query_id), 1, 1) < '8' THEN 'definitely yes' ELSE 'definitely no' END
             WHEN {digit} IN ('8','9','a','b') THEN 'probably yes'
             WHEN {digit} IN ('c','d') THEN 'probably no' ELSE 'uncertain' END AS graded_response
      FROM query_set, (VALUES ('model-a'), ('model-b')) m(model)
    ),
    results AS (
      SELECT *, CASE graded_response WHEN 'definitely yes' THEN 5 WHEN 'probably yes' THEN 4
                  WHEN 'uncertain' THEN 3 WHEN 'probably no' THEN 2 ELSE 1 END AS score,
             graded_response IN ('definitely yes', 'probably yes') AS retrieved
      FROM graded
    )"""


FRAME_SCORES = f"{ov.FRAMES}, {_scores_sql('frames')}"
EXTENDED_SCORES = f"{CANDIDATES}, {_scores_sql('extended')}"
RESULT_COLUMNS = "model, query_id, query_text, image_id, is_positive, graded_response, score, retrieved"


@query(
    "score_frames",
    f"WITH {FRAME_SCORES} SELECT {RESULT_COLUMNS} FROM results WHERE model = 'model-a'",
)
def score_frames(spark, sf):
    pool = fr.frames(spark, sf)
    chosen = sampling.build_query_set(pool, n_queries=N_QUERIES)
    results = inference.score_frames(
        chosen, pool, grade_by_digest, MODELS[:1], max_rows=sampling.query_set_bound(N_QUERIES)
    )
    return results.select(*RESULT_COLUMNS.split(", "))


@query(
    "model_sweep",
    f"WITH {EXTENDED_SCORES} SELECT {RESULT_COLUMNS}, retrieved = is_positive AS correct FROM results",
)
def model_sweep(spark, sf):
    _, results = scored(stored_extended(spark, sf))
    return results.select(*RESULT_COLUMNS.split(", "), "correct")


@query(
    "skipped_frames",
    f"""WITH {ov.FRAMES}, {FRAME_SET}
    SELECT query_id, image_id FROM query_set
    WHERE image_id NOT IN (SELECT image_id FROM frames WHERE xml_path IS NOT NULL)""",
)
def skipped_frames(spark, sf):
    """Sampled frames without a file, if only labelled items had one."""
    pool = fr.frames(spark, sf)
    chosen = sampling.build_query_set(pool, n_queries=N_QUERIES)
    listing = pool.where(F.col("xml_path").isNotNull()).select("image_path")
    bound = sampling.query_set_bound(N_QUERIES)
    return inference.skipped_frames(chosen, pool, listing, bound).select("query_id", "image_id")


METRICS_SQL = f"""
metrics AS (
  SELECT model, query_id, query_text, 5::BIGINT AS n_positive, 5::BIGINT AS n_negative, tp, fp, fn, tn, {ov.metrics(4)}
  FROM (SELECT model, query_id, query_text, {ov.CONFUSION} FROM results GROUP BY ALL)
)"""


@query("query_metrics", f"WITH {FRAME_SCORES}, {METRICS_SQL} SELECT * FROM metrics")
def query_metrics(spark, sf):
    chosen, results = scored(fr.frames(spark, sf))
    return evaluate.query_metrics(results, chosen, MODELS)


@query(
    "run_summary",
    f"""WITH {FRAME_SCORES}, {METRICS_SQL}
    SELECT model, 4 AS retrieval_threshold, count(*) AS n_queries, round(avg(precision), 4) AS mean_precision,
           round(avg(recall), 4) AS mean_recall, round(avg(f1), 4) AS mean_f1,
           array_to_string(list_sort(list(query_id || ':' || tp || '/' || fp || '/' || fn || '/' || tn)), ',') AS per_query
    FROM metrics GROUP BY model""",
)
def run_summary(spark, sf):
    chosen, results = scored(fr.frames(spark, sf))
    summary = evaluate.run_summary(evaluate.query_metrics(results, chosen, MODELS))
    line = lambda q: F.concat(
        q["query_id"], F.lit(":"), F.concat_ws("/", *[q[c].cast("string") for c in ("tp", "fp", "fn", "tn")])
    )
    return summary.withColumn("per_query", F.array_join(F.transform("per_query", line), ","))


def detailed(spark, sf):
    pool = stored_extended(spark, sf)
    chosen, results = scored(pool)
    bound = sampling.query_set_bound(N_QUERIES) * len(MODELS)
    return evaluate.detailed_eval(results, chosen, pool, max_rows=bound)


DETAILED_SQL = f"""{EXTENDED_SCORES},
detailed AS (
  SELECT r.*, r.retrieved = r.is_positive AS correct, e.source_split, e.background, e.lighting, e.blur_bucket,
         e.drone_visibility, e.augmentation_type, e.augment_label, e.curation_status, e.source_image_id,
         coalesce(e.augment_label, CASE WHEN e.augmentation_type = 'gaussian_blur' THEN 'blur' END, 'original') AS condition
  FROM results r LEFT JOIN extended e ON r.image_id = e.image_id
)"""


@query(
    "detailed_eval",
    f"""WITH {DETAILED_SQL}
    SELECT {RESULT_COLUMNS}, correct, source_split, background, lighting, blur_bucket, drone_visibility,
           augmentation_type, augment_label, curation_status, source_image_id, condition FROM detailed""",
)
def detailed_eval(spark, sf):
    return evaluate.with_condition(detailed(spark, sf)).select(
        *RESULT_COLUMNS.split(", "), "correct", "source_split", "background", "lighting", "blur_bucket",
        "drone_visibility", "augmentation_type", "augment_label", "curation_status", "source_image_id", "condition",
    )


def _matrix_sql(key: str, support: int) -> str:
    cells = ", ".join(
        f"avg(CASE WHEN model = '{m}' THEN {x} END) AS \"{m} {x}\"" for x in evaluate.METRICS for m in MODELS
    )
    shown = ", ".join(f"CASE WHEN n >= {support} THEN {x} END AS {x}" for x in evaluate.METRICS)
    rounded = ", ".join(f'round("{m} {x}", 6) AS "{m} {x}"' for x in evaluate.METRICS for m in MODELS)
    return f"""WITH {DETAILED_SQL},
    by_key AS (
      SELECT *, {ov.metrics(2)} FROM (
        SELECT model, {key}, count(*) AS n, {ov.CONFUSION} FROM detailed GROUP BY model, {key})
    ),
    shown AS (SELECT model, {key}, {shown} FROM by_key),
    matrix AS (
      SELECT CASE WHEN grouping({key}) = 1 THEN 'mean' ELSE {key} END AS {key}, {cells}
      FROM shown GROUP BY ROLLUP ({key})
    )
    SELECT {key}, {rounded} FROM matrix"""


def _matrix(df, key, support):
    metrics = evaluate.metrics_by(df, ["model", key], min_support=support)
    matrix = evaluate.metric_matrix(metrics, key, MODELS)
    return matrix.select(key, *[F.round(f"`{c}`", 6).alias(c) for c in matrix.columns if c != key])


@query("eval_matrix", _matrix_sql("query_text", 0))
def eval_matrix(spark, sf):
    return _matrix(detailed(spark, sf), "query_text", 0)


@query("condition_matrix", _matrix_sql("condition", fv.CONDITION_MIN_SUPPORT))
def condition_matrix(spark, sf):
    return _matrix(evaluate.with_condition(detailed(spark, sf)), "condition", fv.CONDITION_MIN_SUPPORT)
