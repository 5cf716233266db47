"""Catalogue queries: augmentation candidates, cache keys and the extended evaluation set."""

from pyspark.sql import functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.text import cache_key, content_b64
from goldquarry.operators import augment
from goldquarry.operators.joins import with_cached
from goldquarry.plans import frames as fr
from goldquarry.plans import oracle_views as ov
from goldquarry.plans.registry import query
from goldquarry.plans.responders import edit_by_digest
from goldquarry.sources.stages import store_stage

PROMPTS_SQL = "(VALUES " + ", ".join(f"('{k}', '{p}')" for k, p in fv.VARIANT_PROMPTS.items()) + ") p(label, prompt)"


def contents(spark, sf):
    """Document texts stand for the bytes of the image files."""
    base = F.concat(F.lit("/data/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg"))
    return fr.table(spark, sf, "documents").select(
        base.alias("image_path"), F.col("text").cast("binary").alias("content")
    )


def stored_golden(spark, sf):
    """The golden set as the stored table that the augmentation steps share."""
    return store_stage(fr.golden(spark, sf), "golden")


def blur_rows(golden):
    return augment.patch_labels(
        augment.blur_candidates(augment.positives(golden), f"{fr.OUT_DIR}/blur")
    )


def variant_rows(golden, spark, sf):
    rows = augment.variant_candidates(
        augment.positives(golden),
        edit_by_digest,
        f"{fr.OUT_DIR}/weather",
        contents=contents(spark, sf),
        store=lambda new: store_stage(new, "variants"),
    )
    return augment.patch_labels(rows)


def extended(spark, sf):
    golden = stored_golden(spark, sf)
    return augment.extend_eval_set(golden, blur_rows(golden), variant_rows(golden, spark, sf))


KEY_SQL = "substr(sha256(base64(encode(d.text)) || '|' || p.prompt), 1, 16)"

CANDIDATES = f"""
{ov.GOLDEN},
targets AS (SELECT * FROM golden WHERE drone_present),
blur AS (
  SELECT * REPLACE (image_id || '__blur' AS image_id, '{fr.OUT_DIR}/blur/' || image_id || '__blur.jpg' AS image_path,
                    'gaussian_blur' AS augmentation_type, image_id AS source_image_id, TRUE AS is_synthetic,
                    'blurry' AS blur_bucket),
         CAST(NULL AS VARCHAR) AS augment_label, CAST(NULL AS VARCHAR) AS openai_augment_status
  FROM targets
),
asked AS (
  SELECT t.*, p.label AS label, substr({KEY_SQL}, 1, 1) NOT IN ('0', '4', '8', 'c') AS ok
  FROM targets t JOIN documents d ON CAST(d.doc_id AS VARCHAR) = t.image_id CROSS JOIN {PROMPTS_SQL}
),
variants AS (
  SELECT * EXCLUDE (label, ok)
           REPLACE (image_id || '__openai_' || label AS image_id,
                    CASE WHEN ok THEN '{fr.OUT_DIR}/weather/' || image_id || '__' || label || '.jpg' END AS image_path,
                    CASE WHEN ok THEN 'openai_image' ELSE 'openai_image_failed' END AS augmentation_type,
                    image_id AS source_image_id, ok AS is_synthetic,
                    CASE WHEN label IN ('night', 'rain', 'fog') THEN 'dark' ELSE lighting END AS lighting,
                    CASE WHEN label = 'fog' THEN 'blurry' ELSE blur_bucket END AS blur_bucket),
         label AS augment_label, CASE WHEN ok THEN 'ok' ELSE 'failed: refused' END AS openai_augment_status
  FROM asked
),
extended AS (
  SELECT *, CAST(NULL AS VARCHAR) AS augment_label, CAST(NULL AS VARCHAR) AS openai_augment_status FROM golden
  UNION ALL BY NAME SELECT * FROM blur
  UNION ALL BY NAME SELECT * FROM variants WHERE is_synthetic
)"""

SHOWN = [
    "image_id", "image_path", "source_image_id", "augmentation_type", "is_synthetic", "background",
    "lighting", "blur_bucket", "drone_visibility",
]
SHOWN_SQL = ", ".join(SHOWN) + ", round(blur_score, 6) AS blur_score"


def _shown(df, *more):
    return df.select(*SHOWN, *more, F.round("blur_score", 6).alias("blur_score"))


@query("blur_candidates", f"WITH {CANDIDATES} SELECT {SHOWN_SQL} FROM blur")
def blur_candidates(spark, sf):
    return _shown(blur_rows(fr.golden(spark, sf)))


@query(
    "variant_candidates",
    f"WITH {CANDIDATES} SELECT {SHOWN_SQL}, augment_label, openai_augment_status FROM variants",
)
def variant_candidates(spark, sf):
    return _shown(variant_rows(stored_golden(spark, sf), spark, sf), "augment_label", "openai_augment_status")


@query(
    "augment_success",
    f"""WITH {CANDIDATES}
    SELECT CASE WHEN grouping(augment_label) = 1 THEN 'total' ELSE augment_label END AS label,
           count(*) FILTER (openai_augment_status = 'ok') AS ok, count(*) AS attempted
    FROM variants GROUP BY ROLLUP (augment_label)""",
)
def augment_success(spark, sf):
    return augment.augment_success(variant_rows(stored_golden(spark, sf), spark, sf))


@query("extended_set", f"WITH {CANDIDATES} SELECT {SHOWN_SQL}, augment_label FROM extended")
def extended_set(spark, sf):
    return _shown(extended(spark, sf), "augment_label")


@query(
    "lineage_pairs",
    f"""WITH {CANDIDATES}, pairs AS (SELECT * FROM blur UNION ALL BY NAME SELECT * FROM variants)
    SELECT p.source_image_id, p.image_id, p.image_path AS variant_path, p.augmentation_type, p.augment_label,
           p.openai_augment_status, p.is_synthetic, g.image_path AS source_path
    FROM pairs p LEFT JOIN golden g ON p.source_image_id = g.image_id""",
)
def lineage_pairs(spark, sf):
    golden = stored_golden(spark, sf)
    candidates = augment.candidate_union(blur_rows(golden), variant_rows(golden, spark, sf))
    return augment.lineage(candidates, golden)


@query(
    "cache_key",
    "SELECT page_id, substr(sha256(base64(encode(html)) || '|' || url), 1, 16) AS cache_key FROM pages",
)
def cache_keys(spark, sf):
    return fr.table(spark, sf, "pages").select(
        "page_id", cache_key(content_b64(F.col("html").cast("binary")), F.col("url")).alias("cache_key")
    )


@query(
    "cache_hits_misses",
    f"""WITH {ov.FRAMES}, keyed AS (
      SELECT f.image_id, f.xml_path, sha256(d.text) AS key FROM frames f
      JOIN documents d ON CAST(d.doc_id AS VARCHAR) = f.image_id
    ),
    cached AS (SELECT DISTINCT key FROM keyed WHERE xml_path IS NOT NULL)
    SELECT image_id, key, key IN (SELECT key FROM cached) AS hit FROM keyed""",
)
def cache_hits_misses(spark, sf):
    """Content-keyed requests against a cache of the labelled documents' texts, copies included."""
    docs = fr.table(spark, sf, "documents")
    requests = docs.select(
        F.col("doc_id").cast("string").alias("image_id"),
        F.sha2(F.col("text").cast("binary"), 256).alias("key"),
    )
    labelled = fr.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("image_id"))
    cache = requests.join(labelled, "image_id", "left_semi").select("key", F.lit("ok").alias("status"))
    return with_cached(requests, cache, "key").select("image_id", "key", "hit")


@query(
    "edit_retry",
    f"""WITH asked AS (SELECT CAST(doc_id AS VARCHAR) AS image_id, substr(sha256(base64(encode(text))), 1, 16) AS key FROM documents),
    edits AS (SELECT key, substr(min(image_id), -1) IN ('1', '2') AS cached_ok, substr(key, 1, 1) NOT IN ('0', '4', '8', 'c') AS edited FROM asked GROUP BY key)
    SELECT key, CASE WHEN cached_ok OR edited THEN 'ok' ELSE 'failed: refused' END AS status, NOT cached_ok AS asked_again FROM edits""",
)
def edit_retry(spark, sf):
    """Edits of which some have succeeded before, some have failed and some were never tried."""
    documents = fr.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("image_id"),
        F.substring(F.sha2(content_b64(F.col("text").cast("binary")).cast("binary"), 256), 1, 16).alias("key"),
    )
    requests = documents.select("key", "image_id", F.lit("/p").alias("image_path"), F.lit("prompt").alias("prompt"))
    last = F.substring(F.min("image_id"), -1, 1)
    cache = requests.groupBy("key").agg(last.alias("d")).where("d < '5'").select(
        "key", F.when(F.col("d").isin("1", "2"), "ok").otherwise("failed: timeout").alias("status")
    )
    outcomes, new = augment.edit_outcomes(requests, edit_by_digest, cache, store=lambda df: store_stage(df, "edits"))
    return outcomes.join(new.select("key", F.lit(True).alias("asked_again")), "key", "left").withColumn(
        "asked_again", F.coalesce("asked_again", F.lit(False))
    )
