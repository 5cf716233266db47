"""Explicit Spark schemas of the tables. No read in this package infers a schema."""

from pyspark.sql import types as T

_S, _I, _D, _B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


BOX = _struct(xmin=_D, ymin=_D, xmax=_D, ymax=_D)
BOXES = T.ArrayType(BOX)

# `_corrupt_record` is set by Spark's XML reader if a record is cut off or a value is not a number.
ANNOTATION_XML = _struct(
    size=_struct(width=_D, height=_D), object=T.ArrayType(_struct(bndbox=BOX)), _corrupt_record=_S
)

BASE = _struct(
    image_id=_S,
    image_path=_S,
    width=_I,
    height=_I,
    drone_present=_B,
    bbox=BOXES,
    box_count=_I,
    source_split=_S,
    xml_path=_S,
    augmentation_type=_S,
    source_image_id=_S,
    is_synthetic=_B,
)

PROVENANCE = _struct(model=_S, caption=_S, response=_S, visibility_source=_S, schema_version=_S)

CURATION = _struct(
    background=_S,
    lighting=_S,
    drone_visibility=_S,
    blur_bucket=_S,
    possible_confusers=T.ArrayType(_S),
    camera_angle=_S,
    depth_range=_S,
    annotator=_S,
    raw=PROVENANCE,
    curation_status=_S,
)

# Files that give no item, and why.
QUARANTINE = _struct(path=_S, reason=_S, source_split=_S)

STATS = _struct(blur_score=_D, brightness=_D, bbox_ratio=_D)

CURATED = T.StructType(BASE.fields + CURATION.fields)
GOLDEN = T.StructType(CURATED.fields + STATS.fields)
AUGMENTED = T.StructType(GOLDEN.fields + _struct(augment_label=_S, openai_augment_status=_S).fields)

RESPONSES = _struct(
    request_key=_S,
    image_id=_S,
    model=_S,
    schema_version=_S,
    raw_text=_S,
    error=_S,
    answered_at=T.TimestampType(),
)

# The object of an answer, kept by request.
ANSWERS = _struct(request_key=_S, json=_S, parse_status=_S, answered_at=T.TimestampType())

FRAME_RESULTS = _struct(
    model=_S,
    query_id=_S,
    query_text=_S,
    image_id=_S,
    is_positive=_B,
    graded_response=_S,
    score=_I,
    retrieved=_B,
    correct=_B,
)

EVAL = T.StructType(
    FRAME_RESULTS.fields
    + [
        f
        for f in AUGMENTED.fields
        if f.name not in ("image_id", "image_path", "xml_path", "bbox", "raw")
    ]
)

# Edits arrive as the strings of a form.
EDIT_FORM = _struct(
    image_id=_S,
    augment_label=_S,
    drone_present=_S,
    drone_visibility=_S,
    curation_status=_S,
    background=_S,
    lighting=_S,
    blur_bucket=_S,
    camera_angle=_S,
    depth_range=_S,
    possible_confusers=_S,
    graded_response=_S,
    score=_S,
)

IMAGE = _struct(origin=_S, height=_I, width=_I, nChannels=_I, mode=_I, data=T.BinaryType())

ARTIFACT_SCHEMAS = {
    "raw": BASE,
    "curated": CURATED,
    "golden": GOLDEN,
    "augmented": AUGMENTED,
    "eval": EVAL,
}
