"""Model-in-the-loop jobs: annotation and scoring through a pluggable responder.

A responder is a picklable ``f(requests: pandas.DataFrame) -> sequence of str or None``. It gets
a batch of requests (see the columns each job documents) and returns one raw answer per row,
None for a failed call. Retries and rate limits belong inside the responder.
"""

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from goldquarry import fixed_values as fv
from goldquarry.functions.geometry import visibility_bucket
from goldquarry.functions.labels import coerce_enum, coerce_labels, curation_status, grade, retrieved
from goldquarry.functions.text import curation_prompt, retrieval_prompt
from goldquarry.operators.batches import bisected
from goldquarry.operators.extract import extract_json
from goldquarry.operators.joins import small_side, unique_rows
from goldquarry.operators.sampling import with_models

ANSWER = (
    "background string, lighting string, blur_bucket string, possible_confusers array<string>, "
    "camera_angle string, depth_range string, caption string"
)


def _answers(responder: Callable, batch: pd.DataFrame) -> pd.DataFrame:
    """Raw answers of a batch; failing rows are found by halving."""
    return pd.DataFrame(bisected(responder, batch), columns=["raw_text", "error"], index=batch.index, dtype=object)


def run_responder(
    requests: DataFrame, responder: Callable, parallelism: int | None = None, hidden: tuple[str, ...] = ()
) -> DataFrame:
    """Requests with `raw_text` and `error`; request content is not returned.

    The responder doesn't see the `hidden` columns.

    `parallelism` fixes the number of concurrent tasks, for slow calls over few rows.
    """
    kept = [f for f in requests.schema.fields if f.dataType != T.BinaryType()]
    names = [f.name for f in kept]
    schema = T.StructType(
        kept + [T.StructField("raw_text", T.StringType()), T.StructField("error", T.StringType())]
    )

    def run(batches):
        for batch in batches:
            yield batch[names].join(_answers(responder, batch.drop(columns=list(hidden))))

    if parallelism:
        requests = requests.repartition(parallelism)
    return requests.mapInPandas(run, schema)


def response_schema() -> str:
    """JSON schema of an annotation answer: every field, closed to its vocabulary.

    Values that stand for a missing answer are not offered.
    """
    fields = {}
    for name, description in fv.RESPONSE_DESCRIPTIONS.items():
        if name in fv.ENUM_DEFAULTS:
            values = [v for v in fv.ENUM_DEFAULTS[name][0] if v != "unknown"]
            fields[name] = {"type": "string", "enum": values}
        elif name == "possible_confusers":
            fields[name] = {"type": "array", "items": {"type": "string", "enum": list(fv.CONFUSERS)}}
        else:
            fields[name] = {"type": "string"}
        fields[name]["description"] = description
    return json.dumps({"type": "object", "properties": fields, "required": list(fields), "additionalProperties": False})


def request_key(image_id: Column, model: str, prompt: Column, schema_version: str) -> Column:
    """Key of an annotation request; a new model, prompt or schema version asks again."""
    parts = F.concat_ws("|", image_id, F.lit(model), prompt, F.lit(schema_version))
    return F.sha2(parts.cast("binary"), 256)


def valid_responses(responses: DataFrame) -> DataFrame:
    """Stored responses that can be reused, parsed: the newest answer of each request that holds an object.

    Fields the object lacks get their defaults like those of any answer, so they are no reason to ask
    again. Responses without a time are older than all others.
    """
    if "answered_at" not in responses.columns:
        responses = responses.withColumn("answered_at", F.lit(None).cast("timestamp"))
    parsed = extract_json(responses.where(F.col("error").isNull()), "raw_text")
    parsed = parsed.where(F.col("json").isNotNull()).select(
        "request_key", "raw_text", "json", "parse_status", "answered_at"
    )
    return unique_rows(parsed, "request_key", last_by="answered_at")


def parsed_answers(responses: DataFrame) -> DataFrame:
    """(request_key, json, parse_status, answered_at) of the answers that hold an object, to be kept for later runs."""
    parsed = extract_json(responses.where(F.col("error").isNull()), "raw_text")
    return parsed.where(F.col("json").isNotNull()).select("request_key", "json", "parse_status", "answered_at")


def newest_answers(answers: DataFrame) -> DataFrame:
    """The newest of the parsed answers of each request; of a table bucketed by request_key nothing moves."""
    newest = F.max_by(F.struct("json", "parse_status"), F.struct("answered_at", "json"))
    return answers.groupBy("request_key").agg(newest.alias("a")).select("request_key", "a.*")


def normalise_annotation(
    df: DataFrame, annotator: str, model: str, schema_version: str = fv.SCHEMA_VERSION
) -> DataFrame:
    """Turn the extracted answer (`json`) into controlled label columns and provenance.

    Object size comes from the boxes, never from the model.
    """
    answer = F.from_json("json", ANSWER)
    labels = {
        name: coerce_enum(F.col("_answer")[name], domain, default)
        for name, (domain, default) in fv.ENUM_DEFAULTS.items()
    }
    raw = F.struct(
        F.lit(model).alias("model"),
        F.coalesce(F.col("_answer")["caption"], F.lit("")).alias("caption"),
        F.col("json").alias("response"),
        F.lit(fv.VISIBILITY_SOURCE).alias("visibility_source"),
        F.lit(schema_version).alias("schema_version"),
    )
    return (
        df.withColumn("_answer", answer)
        .withColumns(
            {
                **labels,
                "drone_visibility": visibility_bucket(
                    F.col("drone_present"), F.col("bbox"), F.col("width"), F.col("height")
                ),
                "possible_confusers": coerce_labels(F.col("_answer")["possible_confusers"]),
                "annotator": F.lit(annotator),
                "raw": raw,
            }
        )
        .withColumn("curation_status", curation_status(F.col("possible_confusers")))
        .drop("_answer")
    )


def annotate(
    items: DataFrame,
    responder: Callable,
    model: str,
    annotator: str = fv.ANNOTATORS[0],
    responses: DataFrame | None = None,
    images: DataFrame | None = None,
    schema_version: str = fv.SCHEMA_VERSION,
    refresh: bool = False,
    parallelism: int | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda new: new,
    answers: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(annotated items, new responses).

    Items whose request is answered in `responses`, or in a table of parsed `answers` (see
    `parsed_answers`; bucketed by request_key it is not shuffled), are not asked again unless `refresh`. The
    responder sees model, image_id, image_path, prompt, request_key, schema_version, response_schema
    (the JSON schema an answer is to follow) and, with `images` (image_path, content), the file content; over many items it is better to leave
    `images` out and let the responder open the path, as the content then need not be shuffled. Pass a `store` that writes the new
    responses and returns the written table (see `sources.stages`) when calls must not repeat.
    """
    if annotator not in fv.ANNOTATORS:
        raise ValueError(f"Unsupported annotator {annotator!r}; known: {sorted(fv.ANNOTATORS)}")
    prompt = curation_prompt(F.col("image_id"), F.col("drone_present"), F.col("box_count"))
    keyed = items.withColumn(
        "request_key", request_key(F.col("image_id"), model, prompt, schema_version)
    )
    requests = keyed.select(
        "request_key",
        "image_id",
        "image_path",
        prompt.alias("prompt"),
        F.lit(model).alias("model"),
        F.lit(schema_version).alias("schema_version"),
        F.lit(response_schema()).alias("response_schema"),
    ).dropDuplicates(["request_key"])
    known = []
    if responses is not None and not refresh:
        known.append(valid_responses(responses).select("request_key", "json", "parse_status"))
    if answers is not None and not refresh:
        known.append(newest_answers(answers))
    # Request keys are distinct on both sides, so no key is hot.
    for cached in known:
        requests = requests.join(cached.select("request_key"), "request_key", "left_anti")
    if images is not None:
        requests = requests.join(images.select("image_path", "content"), "image_path", "left")
    new = run_responder(requests, responder, parallelism).select(
        "request_key", "image_id", "model", "schema_version", "raw_text", "error", F.current_timestamp().alias("answered_at")
    )
    new = store(new)
    # A request key repeats only where an item does, so no key is hot. Each table is joined by itself, so a bucketed
    # one stays where it is. Requests with a kept answer were not asked again.
    joined = keyed.join(extract_json(new, "raw_text").select("request_key", "json", "parse_status"), "request_key", "left")
    for cached in known:
        kept = cached.select("request_key", F.col("json").alias("_json"), F.col("parse_status").alias("_status"))
        joined = joined.join(kept, "request_key", "left").withColumns(
            {
                "parse_status": F.when(F.col("json").isNull() & F.col("_json").isNotNull(), F.col("_status")).otherwise(F.col("parse_status")),
                "json": F.coalesce("json", "_json"),
            }
        ).drop("_json", "_status")
    joined = joined.drop("request_key")
    annotated = normalise_annotation(joined, annotator, model, schema_version)
    return annotated.drop("json").withColumnRenamed("parse_status", "annotation_status"), new


def score_frames(
    query_set: DataFrame,
    items: DataFrame,
    responder: Callable,
    models,
    images: DataFrame | None = None,
    listing: DataFrame | None = None,
    max_rows: int | None = None,
    parallelism: int | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda raw: raw,
) -> DataFrame:
    """One graded result per (model, query, frame) of the query set.

    The responder sees model, query_id, query_text, image_id, image_path, prompt and, with `images`
    (image_path, content), content, but not whether the frame is a positive. Frames that are not in `items`, or with
    `images` or a `listing` have no file, are left out (see `skipped_frames`); if an id repeats
    in `items` the row with the largest path counts. Failed calls count as uncertain and keep their `error`. `max_rows` is
    a proven bound on the size of the query set, if there is one.
    """
    wanted = query_set.select("query_id", "query_text", "image_id", "is_positive")
    # The table of items is only scanned: the small query set goes to it.
    found = items.select("image_id", "image_path").join(
        small_side(wanted, max_rows), "image_id"
    )
    if listing is not None:
        found = found.join(listing.select("image_path"), "image_path", "left_semi")
    frames = found.groupBy("query_id", "query_text", "image_id", "is_positive").agg(
        F.max("image_path").alias("image_path")
    )
    if images is not None:
        # The sampled frames go to the files, so the content of no other file moves.
        content = images.select("image_path", "content")
        frames = content.join(small_side(frames, max_rows), "image_path")
    requests = with_models(frames, models).withColumn(
        "prompt", retrieval_prompt(F.col("query_text"))
    )
    raw = store(run_responder(requests, responder, parallelism, hidden=("is_positive",)).drop("prompt"))
    return grade_results(raw)


def grade_results(raw: DataFrame) -> DataFrame:
    """Add grade, score, retrieved and correct to raw answers."""
    graded = raw.withColumn("_g", grade(F.col("raw_text")))
    return graded.select(
        "model",
        "query_id",
        "query_text",
        "image_id",
        "is_positive",
        F.coalesce("raw_text", F.lit("")).alias("raw_response"),
        "error",
        "_g.graded_response",
        "_g.score",
        retrieved(F.col("_g.score")).alias("retrieved"),
        (retrieved(F.col("_g.score")) == F.col("is_positive")).alias("correct"),
    )


def skipped_frames(
    query_set: DataFrame, items: DataFrame, listing: DataFrame | None = None, max_rows: int | None = None
) -> DataFrame:
    """Sampled frames without a row, or without a file, that scoring leaves out.

    The items and the listing are only scanned: they are first reduced to what was sampled.
    """
    wanted = query_set.select("query_id", "image_id")
    found = items.join(small_side(wanted.select("image_id").distinct(), max_rows), "image_id", "left_semi")
    found = found.select("image_id", "image_path") if listing is not None else found.select("image_id")
    if listing is not None:
        paths = small_side(found.select("image_path").distinct(), max_rows)
        there = listing.join(paths, "image_path", "left_semi").select("image_path").distinct()
        found = found.join(small_side(there, max_rows), "image_path", "left_semi").select("image_id")
    return wanted.join(found.distinct(), "image_id", "left_anti")
