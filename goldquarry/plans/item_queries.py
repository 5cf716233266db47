"""Catalogue queries: ingest, geometry, normalisation, quality and record maintenance."""

from pyspark.sql import functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions import geometry as geo
from goldquarry.functions import labels as lab
from goldquarry.functions import text
from goldquarry.functions.predicates import has_value
from goldquarry.operators import coverage, curate, joins, quality
from goldquarry.operators.extract import extract_json
from goldquarry.operators.pixels import with_box_ratio
from goldquarry.plans import frames as fr
from goldquarry.plans import oracle_views as ov
from goldquarry.plans.registry import query
from goldquarry.sources.annotations import parse_annotations
from goldquarry.sources.items import assemble_items
from goldquarry.sources.stages import store_stage


@query(
    "ingest_left_annotations",
    f"""WITH {ov.FRAMES}
    SELECT image_id, image_path, source_split, xml_path,
           CASE WHEN xml_path IS NULL THEN 0 ELSE width END AS width,
           CASE WHEN xml_path IS NULL THEN 0 ELSE height END AS height,
           CASE WHEN xml_path IS NULL THEN 0 ELSE box_count END AS box_count,
           xml_path IS NOT NULL AND box_count > 0 AS drone_present,
           augmentation_type, is_synthetic
    FROM frames""",
)
def ingest_left_annotations(spark, sf):
    items = fr.frames(spark, sf)
    sidecars = items.where(F.col("xml_path").isNotNull()).select(
        "image_id", "xml_path", "width", "height", "bbox"
    )
    images = items.select("image_id", "image_path", "source_split")
    return assemble_items(images, sidecars).select(
        "image_id", "image_path", "source_split", "xml_path", "width", "height", "box_count",
        "drone_present", "augmentation_type", "is_synthetic",
    )


@query(
    "xml_boxes",
    """SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity) AS INTEGER) AS width,
              CAST(l_partkey AS INTEGER) AS height,
              CASE WHEN l_returnflag = 'N' THEN 0 ELSE 2 END AS n_boxes,
              CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS xmax,
              CASE WHEN l_returnflag <> 'N' THEN 0.0::DOUBLE END AS second_ymin
       FROM lineitem""",
)
def xml_boxes(spark, sf):
    """Annotation XML built from every line item and parsed back; returned items carry boxes."""
    num = lambda c: F.col(c).cast("string")
    boxes = F.concat(
        F.lit("<object><name>a</name><bndbox><xmin>1</xmin><ymin>2</ymin><xmax>"),
        num("l_extendedprice"),
        F.lit("</xmax><ymax>3</ymax></bndbox></object><object><name>nobox</name></object>"),
        F.lit("<object><bndbox><xmin>5</xmin><xmax>6</xmax><ymax>7</ymax></bndbox></object>"),
    )
    xml = F.concat(
        F.lit("<annotation><size><width>"),
        (F.col("l_quantity") + 0.5).cast("string"),
        F.lit("</width><height>"),
        num("l_partkey"),
        F.lit("</height></size>"),
        F.when(F.col("l_returnflag") == "N", "<object><name>nobox</name></object>").otherwise(boxes),
        F.lit("</annotation>"),
    )
    lines = fr.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_extendedprice", "l_returnflag"
    )
    parsed = parse_annotations(lines.withColumn("xml", xml), "xml")
    return parsed.select(
        "l_orderkey",
        "l_linenumber",
        "width",
        "height",
        F.size("bbox").alias("n_boxes"),
        F.get("bbox", 0)["xmax"].alias("xmax"),
        F.get("bbox", 1)["ymin"].alias("second_ymin"),
    )


@query(
    "xml_quarantine",
    """SELECT l_orderkey, l_linenumber,
         CASE WHEN l_linenumber IN (2, 3) THEN 'unreadable annotation' END AS xml_error,
         CASE WHEN l_linenumber NOT IN (2, 3) THEN CAST(l_partkey AS INTEGER) END AS width,
         CASE WHEN l_linenumber NOT IN (2, 3) THEN 1 END AS n_boxes
       FROM lineitem""",
)
def xml_quarantine(spark, sf):
    """Annotations of which some are cut off and some hold a word where a number belongs."""
    corner = F.when(F.col("l_linenumber") == 2, "abc").otherwise(F.col("l_quantity").cast("string"))
    whole = F.concat(
        F.lit("<annotation><size><width>"), F.col("l_partkey").cast("string"), F.lit("</width><height>9</height></size>"),
        F.lit("<object><bndbox><xmin>"), corner, F.lit("</xmin></bndbox></object></annotation>"),
    )
    xml = F.when(F.col("l_linenumber") == 3, F.substring(whole, 1, 60)).otherwise(whole)
    lines = fr.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", xml.alias("xml"))
    parsed = parse_annotations(lines, "xml")
    return parsed.select("l_orderkey", "l_linenumber", "xml_error", "width", F.when(F.col("bbox").isNotNull(), F.size("bbox")).alias("n_boxes"))


@query(
    "split_presence_counts",
    f"WITH {ov.FRAMES} SELECT source_split, drone_present, count(*) AS count FROM frames GROUP BY ALL",
)
def split_presence_counts(spark, sf):
    return coverage.split_counts(fr.frames(spark, sf))


@query(
    "presence_totals",
    f"""WITH {ov.FRAMES}
    SELECT count(*) FILTER (drone_present) AS positives, count(*) FILTER (NOT drone_present) AS negatives,
           count(xml_path) AS with_xml, count(*) AS total FROM frames""",
)
def presence_totals(spark, sf):
    return coverage.totals(fr.frames(spark, sf))


@query(
    "box_geometry",
    f"""WITH {ov.FRAMES}
    SELECT image_id, b.xmax - b.xmin AS box_width, b.ymax - b.ymin AS box_height,
           greatest(b.xmax - b.xmin, 0) * greatest(b.ymax - b.ymin, 0) AS box_area
    FROM (SELECT image_id, unnest(bbox) AS b FROM frames)""",
)
def box_geometry(spark, sf):
    boxes = fr.frames(spark, sf).select("image_id", F.explode("bbox").alias("b"))
    b = F.col("b")
    return boxes.select(
        "image_id",
        geo.box_width(b).alias("box_width"),
        geo.box_height(b).alias("box_height"),
        geo.box_area(b).alias("box_area"),
    )


@query(
    "box_ratio",
    f"""WITH {ov.FRAMES}
    SELECT image_id, CASE WHEN drone_present AND {ov.FRACTION} > 0
                          THEN round({ov.FRACTION}, 6) END AS bbox_ratio FROM frames""",
)
def box_ratio(spark, sf):
    return with_box_ratio(fr.frames(spark, sf)).select(
        "image_id", F.round("bbox_ratio", 6).alias("bbox_ratio")
    )


@query("visibility_bucket", f"WITH {ov.FRAMES} SELECT image_id, drone_visibility FROM frames")
def visibility_bucket(spark, sf):
    return fr.frames(spark, sf).select("image_id", "drone_visibility")


@query(
    "box_rescale",
    f"""WITH {ov.FRAMES}
    SELECT image_id, round(b.xmin * 200 / width, 6) AS xmin, round(b.ymin * 150 / height, 6) AS ymin,
           round(b.xmax * 200 / width, 6) AS xmax, round(b.ymax * 150 / height, 6) AS ymax
    FROM (SELECT image_id, width, height, unnest(bbox) AS b FROM frames)""",
)
def box_rescale(spark, sf):
    scaled = geo.rescale_boxes(F.col("bbox"), F.col("width"), F.col("height"), 200, 150)
    boxes = fr.frames(spark, sf).select("image_id", F.explode(scaled).alias("b"))
    return boxes.select("image_id", *[F.round(f"b.{c}", 6).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


DIRTY_SQL = """
dirty AS (
  SELECT doc_id,
    CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN [] WHEN 2 THEN [' Kite ', 'BIRD.', 'none']
      WHEN 3 THEN ['plane!?', 'helicopter', lang] WHEN 4 THEN ['none;', 'None'] ELSE ['Airplane', 'bird', 'Bird'] END AS confusers,
    CASE doc_id % 4 WHEN 0 THEN 'sky' WHEN 1 THEN 'Sky' WHEN 2 THEN lang ELSE NULL END AS background,
    CASE doc_id % 4 WHEN 0 THEN 'blurry' WHEN 1 THEN 'unknown' WHEN 2 THEN source ELSE NULL END AS blur_bucket
  FROM documents
)"""


def _dirty(spark, sf):
    """Documents with label fields as a model might spell them."""
    six, four = F.pmod("doc_id", F.lit(6)), F.pmod("doc_id", F.lit(4))
    strings = lambda *v: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in v])
    return fr.table(spark, sf, "documents").select(
        "doc_id",
        F.when(six == 1, F.array().cast("array<string>"))
        .when(six == 2, strings(" Kite ", "BIRD.", "none"))
        .when(six == 3, strings("plane!?", "helicopter", F.col("lang")))
        .when(six == 4, strings("none;", "None"))
        .when(six == 5, strings("Airplane", "bird", "Bird"))
        .alias("confusers"),
        F.when(four == 0, "sky").when(four == 1, "Sky").when(four == 2, F.col("lang")).alias("background"),
        F.when(four == 0, "blurry").when(four == 1, "unknown").when(four == 2, F.col("source")).alias("blur_bucket"),
    )


@query(
    "normalise_confusers",
    f"""WITH {DIRTY_SQL},
    named AS (
      SELECT doc_id, list_transform(confusers, lambda c: rtrim(lower(trim(c)), '.,;:!?')) AS c FROM dirty
    ),
    mapped AS (
      SELECT doc_id, list_sort(list_distinct(list_filter(list_transform(c, lambda k:
        CASE k WHEN 'airplane' THEN 'aircraft' WHEN 'plane' THEN 'aircraft' WHEN 'kite' THEN 'bird' ELSE k END),
        lambda k: k IN ('bird', 'aircraft', 'helicopter')))) AS c FROM named
    )
    SELECT doc_id, CASE WHEN len(c) > 0 THEN array_to_string(c, ',') ELSE 'none' END AS confusers FROM mapped""",
)
def normalise_confusers(spark, sf):
    return _dirty(spark, sf).select(
        "doc_id", F.array_join(lab.coerce_labels(F.col("confusers")), ",").alias("confusers")
    )


@query(
    "coerce_enums",
    f"""WITH {DIRTY_SQL}
    SELECT doc_id,
      CASE WHEN background IN ('sky', 'trees', 'building', 'cluttered', 'unknown') THEN background ELSE 'unknown' END AS background,
      CASE WHEN blur_bucket IN ('sharp', 'mild', 'blurry') THEN blur_bucket ELSE 'sharp' END AS blur_bucket
    FROM dirty""",
)
def coerce_enums(spark, sf):
    return _dirty(spark, sf).select(
        "doc_id",
        *[lab.coerce_enum(F.col(n), *fv.ENUM_DEFAULTS[n]).alias(n) for n in ("background", "blur_bucket")],
    )


@query(
    "extract_json_props",
    """SELECT event_id, CASE WHEN event_id % 6 = 5 THEN 'no_object' ELSE 'ok' END AS parse_status,
              CASE WHEN event_id % 6 <> 5 THEN json_extract_string(props, '$.k') END AS k
       FROM events""",
)
def extract_json_props(spark, sf):
    """Event properties wrapped the way model answers wrap their object."""
    form, props = F.pmod("event_id", F.lit(6)), F.col("props")
    answer = (
        F.when(form == 0, props)
        .when(form == 1, F.concat(F.lit("```JSON\n"), props, F.lit("\n```")))
        .when(form == 2, F.concat(F.lit('<think>is it {"k": 0}?\n</think>\n'), props))
        .when(form == 3, F.concat(F.lit('first {"k": -1, "n": {"m": [1]}} { then '), props, F.lit(" done")))
        .when(form == 4, F.concat(F.lit("["), props, F.lit("]")))
        .otherwise("nothing to report")
    )
    events = fr.table(spark, sf, "events").select("event_id", answer.alias("answer"))
    return extract_json(events, "answer").select(
        "event_id", "parse_status", F.get_json_object("json", "$.k").alias("k")
    )


@query(
    "grade_responses",
    """WITH spliced AS (
      SELECT conv_id, turn, lower(CASE turn % 7
        WHEN 0 THEN text || ' Definitely Yes' WHEN 1 THEN 'probably no, ' || text
        WHEN 2 THEN 'definitely not: ' || text WHEN 3 THEN text || ' PROBABLY YES probably no'
        WHEN 4 THEN text || ' uncertain' WHEN 5 THEN NULL ELSE text END) AS a
      FROM conversations),
    graded AS (
      SELECT conv_id, turn, CASE WHEN a LIKE '%definitely yes%' THEN 'definitely yes'
        WHEN a LIKE '%definitely no%' THEN 'definitely no' WHEN a LIKE '%probably yes%' THEN 'probably yes'
        WHEN a LIKE '%probably no%' THEN 'probably no' ELSE 'uncertain' END AS graded_response
      FROM spliced)
    SELECT conv_id, turn, graded_response,
      CASE graded_response WHEN 'definitely yes' THEN 5 WHEN 'probably yes' THEN 4 WHEN 'uncertain' THEN 3
        WHEN 'probably no' THEN 2 ELSE 1 END AS score,
      graded_response IN ('definitely yes', 'probably yes') AS retrieved FROM graded""",
)
def grade_responses(spark, sf):
    turn, said = F.pmod("turn", F.lit(7)), F.col("text")
    answer = (
        F.when(turn == 0, F.concat(said, F.lit(" Definitely Yes")))
        .when(turn == 1, F.concat(F.lit("probably no, "), said))
        .when(turn == 2, F.concat(F.lit("definitely not: "), said))
        .when(turn == 3, F.concat(said, F.lit(" PROBABLY YES probably no")))
        .when(turn == 4, F.concat(said, F.lit(" uncertain")))
        .when(turn == 5, F.lit(None).cast("string"))
        .otherwise(said)
    )
    turns = fr.table(spark, sf, "conversations").select("conv_id", "turn", lab.grade(answer).alias("g"))
    return turns.select(
        "conv_id", "turn", "g.graded_response", "g.score", lab.retrieved(F.col("g.score")).alias("retrieved")
    )


RETRIEVAL_PROMPT_SQL = " || source_split || ".join(
    "'" + part.replace("'", "''") + "'" for part in fv.RETRIEVAL_PROMPT.split("{query}")
)


@query(
    "prompt_render",
    f"""WITH {ov.FRAMES}
    SELECT image_id, '{{"image_id": "' || image_id || '", "ground_truth_drone_present": "'
           || CASE WHEN drone_present THEN 'yes' ELSE 'no' END || '", "ground_truth_box_count": '
           || box_count || '}}' AS context,
           md5({RETRIEVAL_PROMPT_SQL}) AS retrieval_prompt_md5
    FROM frames""",
)
def prompt_render(spark, sf):
    return fr.frames(spark, sf).select(
        "image_id",
        text.annotation_context(F.col("image_id"), F.col("drone_present"), F.col("box_count")).alias("context"),
        F.md5(text.retrieval_prompt(F.col("source_split")).cast("binary")).alias("retrieval_prompt_md5"),
    )


@query("first_rows", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def first_rows(spark, sf):
    return quality.first_n(fr.table(spark, sf, "documents"), 100, "doc_id").select("doc_id", "lang")


@query(
    "first_rows_large",
    """SELECT l_orderkey, count(*) AS n FROM (SELECT l_orderkey FROM lineitem ORDER BY l_orderkey LIMIT 20000)
       GROUP BY l_orderkey""",
)
def first_rows_large(spark, sf):
    """Keys repeat, so the last one is cut; which of its rows come first is a matter of the rows' hashes."""
    rows = quality.first_n(fr.table(spark, sf, "lineitem"), 20_000, "l_orderkey")
    return rows.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "missing_values",
    """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN FALSE WHEN 1 THEN FALSE WHEN 2 THEN FALSE WHEN 3 THEN FALSE
                ELSE lower(text) NOT IN ('', 'none', 'nan') END AS has_text,
              doc_id % 6 NOT IN (2, 3) AS has_number
       FROM documents""",
)
def missing_values(spark, sf):
    six = F.pmod("doc_id", F.lit(6))
    spliced = (
        F.when(six == 0, "").when(six == 1, "None").when(six == 2, "NaN").when(six == 4, F.col("text"))
        .when(six == 5, F.col("text"))
    )
    number = F.when(six == 2, F.lit(float("nan"))).when(six != 3, F.col("n_chars").cast("double"))
    return fr.table(spark, sf, "documents").select(
        "doc_id", has_value(spliced).alias("has_text"), has_value(number).alias("has_number")
    )


@query(
    "grid_stats",
    f"WITH {ov.PIXELS} SELECT image_id, round(blur_score, 6) AS blur_score, round(brightness, 6) AS brightness FROM stats",
)
def grid_statistics(spark, sf):
    return fr.grid_statistics(spark, sf).select(
        "image_id", F.round("blur_score", 6).alias("blur_score"), F.round("brightness", 6).alias("brightness")
    )


@query(
    "attach_stats",
    f"""WITH {ov.CURATED}
    SELECT image_id, width, height, round(blur_score, 6) AS blur_score, round(brightness, 6) AS brightness,
           round(bbox_ratio, 6) AS bbox_ratio FROM curated""",
)
def attach_stats(spark, sf):
    return fr.curated(spark, sf).select(
        "image_id", "width", "height",
        *[F.round(c, 6).alias(c) for c in ("blur_score", "brightness", "bbox_ratio")],
    )


@query(
    "curation_status",
    f"""WITH {ov.FRAMES}
    SELECT image_id, CASE WHEN len(possible_confusers) > 0 AND possible_confusers <> ['none']
                          THEN 'needs_review' ELSE 'keep' END AS curation_status FROM frames""",
)
def curation_status(spark, sf):
    return fr.frames(spark, sf).select(
        "image_id", lab.curation_status(F.col("possible_confusers")).alias("curation_status")
    )


@query(
    "status_counts",
    f"WITH {ov.CURATED} SELECT curation_status, count(*) AS count FROM curated GROUP BY ALL",
)
def status_counts(spark, sf):
    return coverage.value_counts(fr.curated(spark, sf), "curation_status")


@query(
    "quality_filter",
    f"""WITH {ov.GOLDEN}
    SELECT image_id, source_split, drone_present, drone_visibility, background, lighting, blur_bucket,
           camera_angle, depth_range, array_to_string(possible_confusers, ',') AS possible_confusers,
           curation_status, round(blur_score, 6) AS blur_score, round(brightness, 6) AS brightness
    FROM golden""",
)
def quality_filter(spark, sf):
    return fr.golden(spark, sf).select(
        "image_id", "source_split", "drone_present", "drone_visibility", "background", "lighting",
        "blur_bucket", "camera_angle", "depth_range",
        F.array_join("possible_confusers", ",").alias("possible_confusers"),
        "curation_status", F.round("blur_score", 6).alias("blur_score"), F.round("brightness", 6).alias("brightness"),
    )


@query(
    "quality_kept_dropped",
    f"""WITH {ov.CURATED}
    SELECT count(*) FILTER ({ov.QUALITY}) AS kept, count(*) FILTER (NOT ({ov.QUALITY})) AS dropped,
           count(*) AS total FROM curated""",
)
def quality_kept_dropped(spark, sf):
    items = fr.curated(spark, sf)
    return quality.kept_dropped(items, quality.quality_predicate(items.columns))


@query(
    "exclusion_filter",
    f"""WITH {ov.FRAMES}
    SELECT image_id, camera_angle, drone_visibility FROM frames
    WHERE camera_angle NOT IN ('eye_level', 'unknown')
      AND (drone_visibility IS NULL OR drone_visibility NOT IN ('small'))""",
)
def exclusion_filter(spark, sf):
    exclude = {"camera_angle": ["eye_level", "unknown"], "drone_visibility": ["small"], "absent": ["x"]}
    kept = quality.quality_filter(fr.frames(spark, sf), ranges={}, exclude=exclude)
    return kept.select("image_id", "camera_angle", "drone_visibility")


DESCRIBED = """
  count(v) AS count, round(avg(v), 3) AS mean, round(stddev_samp(v), 3) AS std, round(min(v), 3) AS min,
  round(quantile_cont(v, 0.25), 3) AS p25, round(quantile_cont(v, 0.5), 3) AS p50,
  round(quantile_cont(v, 0.75), 3) AS p75, round(max(v), 3) AS max"""


@query(
    "describe_stats",
    f"""WITH {ov.CURATED},
    long AS (
      SELECT 'blur_score' AS stat, blur_score AS v FROM curated UNION ALL
      SELECT 'brightness', brightness FROM curated UNION ALL
      SELECT 'bbox_ratio', bbox_ratio FROM curated UNION ALL
      SELECT 'n_chars', n_chars::DOUBLE FROM curated
    )
    SELECT stat, {DESCRIBED} FROM long WHERE v IS NOT NULL GROUP BY stat""",
)
def describe_stats(spark, sf):
    columns = ["blur_score", "brightness", "bbox_ratio", "n_chars"]
    return quality.describe(store_stage(fr.curated(spark, sf).select(*columns), "statistics"), columns)


@query(
    "describe_events",
    f"SELECT 'value' AS stat, {DESCRIBED} FROM (SELECT value AS v FROM events WHERE value IS NOT NULL)",
)
def describe_events(spark, sf):
    return quality.describe(fr.table(spark, sf, "events"), ["value"])


@query(
    "describe_empty",
    f"""SELECT 'value' AS stat, {DESCRIBED} FROM (SELECT value AS v FROM events WHERE value IS NOT NULL)
    UNION ALL SELECT 'nothing', 0, NULL, NULL, NULL, NULL, NULL, NULL, NULL""",
)
def describe_empty(spark, sf):
    """A column without a single value keeps its row."""
    table = fr.table(spark, sf, "events").select("value", F.lit(None).cast("double").alias("nothing"))
    return quality.describe(table, ["value", "nothing"])


@query(
    "histogram_30",
    f"""WITH {ov.CURATED},
    long AS (
      SELECT 'blur_score' AS stat, blur_score AS v FROM curated UNION ALL
      SELECT 'brightness', brightness FROM curated UNION ALL
      SELECT 'bbox_ratio', bbox_ratio FROM curated WHERE drone_present
    ),
    spans AS (SELECT stat, min(v) AS lo, max(v) AS hi FROM long WHERE v IS NOT NULL GROUP BY stat),
    bins AS (SELECT stat, lo, hi, CAST(b AS INTEGER) AS bin FROM spans, range(1, 31) t(b)),
    counts AS (
      SELECT stat, CAST(least(floor((v - lo) * 30.0::DOUBLE / (hi - lo)) + 1, 30) AS INTEGER) AS bin, count(*) AS n
      FROM long JOIN spans USING (stat) WHERE v IS NOT NULL GROUP BY ALL
    )
    SELECT stat, bin, round(lo + (hi - lo) / 30.0::DOUBLE * (bin - 1), 6) AS low,
           round(lo + (hi - lo) / 30.0::DOUBLE * bin, 6) AS high, coalesce(n, 0) AS count
    FROM bins LEFT JOIN counts USING (stat, bin)""",
)
def histogram_30(spark, sf):
    columns = {
        "blur_score": F.col("blur_score"),
        "brightness": F.col("brightness"),
        "bbox_ratio": F.when(F.col("drone_present"), F.col("bbox_ratio")),
    }
    table = quality.histogram(fr.curated(spark, sf), columns)
    return table.withColumns({"low": F.round("low", 6), "high": F.round("high", 6)})


CHOICES = {"source_split": "All", "drone_present": "True", "background": "sky", "model": "m", "drone_visibility": None}


@query(
    "facet_filter",
    f"""WITH {ov.FRAMES}
    SELECT image_id, source_split, background FROM frames
    WHERE drone_present = TRUE AND background = 'sky'""",
)
def facet_filter(spark, sf):
    return quality.facet_filter(fr.frames(spark, sf), CHOICES).select("image_id", "source_split", "background")


@query(
    "facet_counts",
    f"""WITH {ov.FRAMES}
    SELECT count(*) FILTER (drone_present AND background = 'sky') AS kept,
           count(*) - count(*) FILTER (drone_present AND background = 'sky') AS dropped, count(*) AS total FROM frames""",
)
def facet_counts(spark, sf):
    """Shown, hidden and all rows of a facet selection."""
    items = fr.frames(spark, sf)
    return quality.kept_dropped(items, quality.facet_predicate(items, CHOICES))


EDITS_SQL = """
edits AS (
  SELECT CAST(doc_id AS VARCHAR) AS image_id,
         CASE toxic WHEN 1 THEN 'reject' ELSE NULL END AS e_status,
         'trees' AS e_background, quality = 1 AS e_present
  FROM labels
)"""


@query(
    "apply_edits",
    f"""WITH {ov.CURATED}, {EDITS_SQL}
    SELECT c.image_id,
           CASE WHEN e.image_id IS NULL THEN c.curation_status ELSE coalesce(e.e_status, 'keep') END AS curation_status,
           CASE WHEN e.image_id IS NULL THEN c.background ELSE e.e_background END AS background,
           CASE WHEN e.image_id IS NULL THEN c.drone_present ELSE e.e_present END AS drone_present,
           CASE WHEN e.image_id IS NULL THEN c.lighting ELSE 'unknown' END AS lighting,
           CASE WHEN e.image_id IS NULL THEN c.blur_bucket ELSE 'sharp' END AS blur_bucket,
           CASE WHEN e.image_id IS NULL THEN array_to_string(c.possible_confusers, ',')
                ELSE 'aircraft,dog' END AS possible_confusers
    FROM curated c LEFT JOIN edits e ON c.image_id = e.image_id""",
)
def apply_edits(spark, sf):
    """Every labelled document is edited through the string form of the viewer."""
    empty = F.lit("")
    forms = fr.table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("image_id"),
        F.when(F.col("toxic") == 1, "reject").otherwise("").alias("curation_status"),
        F.lit("trees").alias("background"),
        F.when(F.col("quality") == 1, "True").otherwise("false").alias("drone_present"),
        F.lit(" aircraft , dog,").alias("possible_confusers"),
        *[empty.alias(n) for n in ("augment_label", "drone_visibility", "lighting", "blur_bucket",
                                   "camera_angle", "depth_range", "graded_response", "score")],
    )
    edited = curate.apply_edits(fr.curated(spark, sf), curate.parse_edits(forms))
    return edited.select(
        "image_id", "curation_status", "background", "drone_present", "lighting", "blur_bucket",
        F.array_join("possible_confusers", ",").alias("possible_confusers"),
    )


@query(
    "unmatched_edits",
    """SELECT CAST(vec_id AS VARCHAR) AS image_id FROM embeddings
       WHERE vec_id NOT IN (SELECT doc_id FROM labels)""",
)
def unmatched_edits(spark, sf):
    edits = fr.table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("image_id"))
    items = fr.table(spark, sf, "labels").select(F.col("doc_id").cast("string").alias("image_id"))
    return curate.unmatched_edits(items, edits)


@query(
    "key_check",
    "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
)
def key_check(spark, sf):
    return joins.check_unique(fr.table(spark, sf, "lineitem"), "l_orderkey")


@query(
    "reference_check",
    """SELECT DISTINCT CAST(doc_id AS VARCHAR) AS image_id FROM documents
       WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)""",
)
def reference_check(spark, sf):
    return joins.check_refs(fr.frames(spark, sf), fr.grids(spark, sf), "image_id")


@query(
    "file_exists",
    f"""WITH {ov.FRAMES}
    SELECT image_id, image_path, xml_path IS NOT NULL AS file_exists FROM frames""",
)
def file_exists(spark, sf):
    items = fr.frames(spark, sf)
    listing = items.where(F.col("xml_path").isNotNull()).select("image_path")
    return joins.with_file_exists(items.select("image_id", "image_path"), listing)


@query(
    "resolve_path",
    f"""WITH {ov.FRAMES},
    found AS (
      SELECT image_id, image_path, 0 AS priority FROM frames WHERE xml_path IS NOT NULL UNION ALL
      SELECT image_id, image_path || '.golden', 1 FROM frames WHERE drone_present IS NULL AND lighting = 'dark' UNION ALL
      SELECT image_id, image_path || '.aug', 2 FROM frames WHERE background <> 'sky'
    ),
    best AS (SELECT image_id, arg_min(image_path, priority) AS image_path FROM found GROUP BY image_id)
    SELECT f.image_id, b.image_path FROM frames f LEFT JOIN best b ON f.image_id = b.image_id""",
)
def resolve_path(spark, sf):
    """Paths from three datasets; the first lacks the files of unlabelled items."""
    items = fr.frames(spark, sf)
    first = items.select("image_id", "image_path")
    second = items.where((F.col("lighting") == "dark")).select(
        "image_id", F.when(F.col("drone_present").isNull(), F.concat("image_path", F.lit(".golden"))).alias("image_path")
    )
    third = items.where(F.col("background") != "sky").select(
        "image_id", F.concat("image_path", F.lit(".aug")).alias("image_path")
    )
    files = (
        items.where(F.col("xml_path").isNotNull()).select("image_path")
        .unionByName(second.select("image_path"))
        .unionByName(third.select("image_path"))
    )
    return joins.resolve_path(items, [first, second, third], files)
