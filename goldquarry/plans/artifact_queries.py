"""Catalogue queries: artifacts written and read again, a custom query set, display order."""

import uuid

from pyspark.sql import Window, functions as F

from goldquarry import fixed_values as fv
from goldquarry import schema
from goldquarry.operators import coverage, inference
from goldquarry.plans import frames as fr
from goldquarry.plans import oracle_views as ov
from goldquarry.plans.coverage_queries import _coverage_sql
from goldquarry.plans.registry import query
from goldquarry.plans.responders import grade_by_digest
from goldquarry.sources import artifacts
from goldquarry.sources.stages import stage_root


def _folder(spark, name):
    return f"{stage_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _base_rows(spark, sf):
    frames = fr.frames(spark, sf)
    return frames.select(*[F.col(f.name).cast(f.dataType) for f in schema.BASE.fields])


@query(
    "jsonl_round_trip",
    f"""WITH {ov.FRAMES}
    SELECT image_id, image_path, width, height, coalesce(drone_present, FALSE) AS drone_present, box_count, xml_path, is_synthetic
    FROM frames""",
)
def jsonl_round_trip(spark, sf):
    """Records as JSON lines; booleans read from text, unknown ones false."""
    path = _folder(spark, "jsonl")
    artifacts.write_jsonl(_base_rows(spark, sf), path)
    back = artifacts.read_jsonl(spark, path, schema.BASE)
    return back.select("image_id", "image_path", "width", "height", "drone_present", "box_count", "xml_path", "is_synthetic")


@query(
    "coverage_files",
    f"""WITH {ov.FRAMES}, {_coverage_sql('frames')}
    SELECT 'coverage' AS file, dimension, value, count FROM coverage UNION ALL
    SELECT 'coverage_gaps', dimension, value, count FROM coverage WHERE count < 100""",
)
def coverage_files(spark, sf):
    """Coverage and gaps as CSV files, read again."""
    path, frames = _folder(spark, "coverage"), fr.frames(spark, sf)
    table = coverage.coverage(frames, min_count=100)
    artifacts.export_coverage(table, coverage.gaps(table, 100), coverage.crosstabs(frames), path)
    parts = []
    for name in ("coverage", "coverage_gaps"):
        kinds = "value string, count long, has_gap boolean, dimension string" if name == "coverage" else "dimension string, value string, count long, min_count int"
        files = spark.read.schema(kinds).option("header", "true").csv(f"{path}/{name}")
        parts.append(files.select(F.lit(name).alias("file"), "dimension", "value", "count"))
    return parts[0].unionByName(parts[1])


@query(
    "run_files",
    "SELECT source AS run, count(*) AS results, 1 AS summaries FROM documents GROUP BY source",
)
def run_files(spark, sf):
    """Results and summaries of several runs in one write, one folder per run."""
    path = _folder(spark, "runs")
    results = fr.table(spark, sf, "documents").select(F.col("source").alias("model"), "doc_id")
    artifacts.write_run(results, results.groupBy("model").agg(F.count(F.lit(1)).alias("n")), path)
    read = lambda name: spark.read.schema("model string, run string").json(f"{path}/{name}")
    results = read("retrieval_results").groupBy("run").agg(F.count(F.lit(1)).alias("results"))
    summaries = read("retrieval_eval_summary").groupBy("run").agg(F.count(F.lit(1)).cast("int").alias("summaries"))
    return results.join(summaries, "run")


@query(
    "artifact_catalogue",
    f"""WITH {ov.FRAMES}
    SELECT 'raw' AS name, TRUE AS available, count(*) AS rows FROM frames WHERE drone_present UNION ALL
    SELECT unnest(['curated', 'golden', 'augmented', 'eval']), FALSE, 0""",
)
def artifact_catalogue(spark, sf):
    """The last version of a stored artifact counts; the others were not stored."""
    path, rows = _folder(spark, "artifacts"), _base_rows(spark, sf)
    artifacts.write_dataset(rows, path, "raw")
    artifacts.write_dataset(rows.where("drone_present"), path, "raw")
    return artifacts.catalogue(spark, path)


CUSTOM_DIGIT = "substr(md5('model-a|toxic|' || image_id), 1, 1)"


@query(
    "custom_query_set",
    f"""WITH {ov.FRAMES}
    SELECT image_id, toxic = 1 AS is_positive,
      CASE WHEN {CUSTOM_DIGIT} < '8'
             THEN CASE WHEN substr(md5(image_id || '|toxic'), 1, 1) < '8' THEN 'definitely yes' ELSE 'definitely no' END
           WHEN {CUSTOM_DIGIT} IN ('8', '9', 'a', 'b') THEN 'probably yes'
           WHEN {CUSTOM_DIGIT} IN ('c', 'd') THEN 'probably no' ELSE 'uncertain' END AS graded_response
    FROM frames WHERE toxic IS NOT NULL""",
)
def custom_query_set(spark, sf):
    """A query set of the user's own instead of a built one."""
    pool = fr.frames(spark, sf)
    own = pool.where("toxic IS NOT NULL").select(
        F.lit("toxic").alias("query_id"), F.lit("a toxic frame").alias("query_text"), "image_id", (F.col("toxic") == 1).alias("is_positive")
    )
    results = inference.score_frames(own, pool, grade_by_digest, ["model-a"])
    return results.select("image_id", "is_positive", "graded_response")


@query(
    "coverage_order",
    f"""WITH {ov.FRAMES}, {_coverage_sql('frames')}
    SELECT dimension, value, row_number() OVER (PARTITION BY dimension ORDER BY count DESC, value) AS place FROM coverage""",
)
def coverage_order(spark, sf):
    """Places in display order, which is by dimension, then by count."""
    ordered = coverage.ranked(coverage.coverage(fr.frames(spark, sf), fv.COVERAGE_DIMENSIONS))
    # Numbers that rise along the ordered table.
    numbered = ordered.withColumn("at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("dimension").orderBy("at"))
    return numbered.select("dimension", "value", place.cast("long").alias("place"))
