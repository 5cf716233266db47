"""Common table expressions of the oracle SQL (DuckDB dialect)."""

from goldquarry import fixed_values as fv


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values, step: int) -> str:
    return f"{sql_list(values)}[(d.doc_id * {step}) % {len(values)} + 1]"


FRACTION = (
    "list_max(list_transform(bbox, lambda b: greatest(b.xmax - b.xmin, 0.0)"
    " * greatest(b.ymax - b.ymin, 0.0) / (width * height)::DOUBLE))"
)

FRAMES = f"""
frame_rows AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS image_id,
         '/data/' || d.source || '/' || d.doc_id || '.jpg' AS image_path,
         CAST(100 + d.doc_id % 50 AS INTEGER) AS width,
         CAST(80 + d.doc_id % 40 AS INTEGER) AS height,
         l.quality = 1 AS drone_present,
         list_transform(range(1, d.doc_id % 3 + 1), lambda i: {{
             'xmin': i::DOUBLE, 'ymin': i::DOUBLE,
             'xmax': (i + d.n_chars % 20)::DOUBLE, 'ymax': (i + d.doc_id % 11)::DOUBLE}}) AS bbox,
         CAST(d.doc_id % 3 AS INTEGER) AS box_count,
         d.source AS source_split,
         CASE WHEN l.quality IS NOT NULL
              THEN '/data/' || d.source || '/' || d.doc_id || '.xml' END AS xml_path,
         'real' AS augmentation_type,
         CAST(NULL AS VARCHAR) AS source_image_id,
         FALSE AS is_synthetic,
         l.toxic AS toxic,
         d.n_chars AS n_chars,
         CASE d.lang WHEN 'en' THEN 'sky' WHEN 'fr' THEN 'trees' WHEN 'de' THEN 'building'
                     ELSE 'cluttered' END AS background,
         {_pick(fv.LIGHTINGS, 7)} AS lighting,
         {_pick(fv.BLUR_BUCKETS, 5)} AS blur_bucket,
         CASE d.doc_id % 5 WHEN 0 THEN [] WHEN 1 THEN NULL WHEN 2 THEN ['none']
                           WHEN 3 THEN ['bird'] ELSE ['aircraft', 'bird'] END AS possible_confusers,
         {_pick(fv.CAMERA_ANGLES, 11)} AS camera_angle,
         {_pick(fv.DEPTH_RANGES, 13)} AS depth_range
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
frames AS (
  SELECT *, CASE WHEN drone_present THEN
      CASE WHEN {FRACTION} >= 0.02 THEN 'large' WHEN {FRACTION} >= 0.005 THEN 'medium' ELSE 'small' END
      END AS drone_visibility
  FROM frame_rows
)"""

PIXELS = """
grid AS (
  SELECT CAST(vec_id AS VARCHAR) AS image_id,
         list_transform(embedding, lambda v: 127.5 + 240.0 * v::DOUBLE) AS g
  FROM embeddings
),
cells AS (
  SELECT image_id, g, 8 * y + x + 1 AS c
  FROM grid, (SELECT unnest(range(1, 7)) AS y) ys, (SELECT unnest(range(1, 7)) AS x) xs
),
stats AS (
  SELECT c.image_id, var_pop(g[c - 1] + g[c + 1] + g[c - 8] + g[c + 8] - 4.0 * g[c]) AS blur_score,
         any_value(list_avg(g)) AS brightness
  FROM cells c GROUP BY c.image_id
)"""

CURATED = f"""
{FRAMES}, {PIXELS},
clean AS (
  SELECT * EXCLUDE (possible_confusers),
         CASE WHEN len(possible_confusers) > 0 THEN possible_confusers ELSE ['none'] END AS possible_confusers
  FROM frames
),
curated AS (
  SELECT c.*, CASE WHEN c.possible_confusers = ['none'] THEN 'keep' ELSE 'needs_review' END AS curation_status,
         s.blur_score, s.brightness,
         CASE WHEN c.drone_present AND {FRACTION} > 0 THEN {FRACTION} END AS bbox_ratio
  FROM clean c LEFT JOIN stats s USING (image_id)
)"""

QUALITY = """
  (blur_score IS NULL OR blur_score >= 20.0)
  AND (brightness IS NULL OR (brightness >= 25.0 AND brightness <= 235.0))
  AND (camera_angle IS NULL OR camera_angle NOT IN ('top_down', 'worms_eye'))
  AND (depth_range IS NULL OR depth_range NOT IN ('close_up'))"""

GOLDEN = f"{CURATED},\ngolden AS (SELECT * FROM curated WHERE {QUALITY})"


def _matches(values: dict) -> str:
    test = " AND ".join(
        f"{c} = {str(v).lower()}" if isinstance(v, bool) else f"{c} = '{v}'" for c, v in values.items()
    )
    return f"coalesce({test}, FALSE)"


def query_set(pool: str, n_queries: int, n_samples: int, seed: int = 42) -> str:
    """CTEs candidates, eligible and query_set over a table of items."""
    parts = " UNION ALL ".join(
        f"SELECT image_id, {i} AS position, '{q}' AS query_id, '{t}' AS query_text, "
        f"{_matches(v)} AS is_positive FROM {pool}"
        for i, (q, t, v) in enumerate(fv.QUERY_TEMPLATES)
    )
    return f"""
candidates AS ({parts}),
template_counts AS (
  SELECT position, query_id, query_text,
         count(*) FILTER (is_positive) AS n_positive, count(*) FILTER (NOT is_positive) AS n_negative
  FROM candidates GROUP BY ALL
),
eligible AS (
  SELECT *, n_positive >= {n_samples} AND n_negative >= {n_samples} AS eligible FROM template_counts
),
chosen AS (
  SELECT query_id FROM eligible WHERE eligible ORDER BY position LIMIT {n_queries}
),
query_set AS (
  SELECT query_id, query_text, image_id, is_positive FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id, is_positive
             ORDER BY md5('{seed}|' || image_id) < substr(md5('{seed}|' || query_id), 1, 3),
                      md5('{seed}|' || image_id), image_id) AS rn
    FROM candidates WHERE query_id IN (SELECT query_id FROM chosen))
  WHERE rn <= {n_samples}
)"""


def metrics(digits: int) -> str:
    p = "coalesce(tp / nullif(tp + fp, 0), 0)"
    r = "coalesce(tp / nullif(tp + fn, 0), 0)"
    f = f"coalesce(2 * {p} * {r} / nullif({p} + {r}, 0), 0)"
    return (
        f"round({p}, {digits}) AS precision, round({r}, {digits}) AS recall, round({f}, {digits}) AS f1"
    )


CONFUSION = """
  count(*) FILTER (is_positive AND retrieved) AS tp,
  count(*) FILTER (NOT is_positive AND retrieved) AS fp,
  count(*) FILTER (is_positive AND NOT retrieved) AS fn,
  count(*) FILTER (NOT is_positive AND NOT retrieved) AS tn"""
