"""Text helpers: whitespace, prompts, content encoding and keys."""

import sys

from pyspark.sql import Column, functions as F

from goldquarry import fixed_values as fv

# All Unicode whitespace, by rule; Spark's plain trim only removes spaces.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def strip_space(col: Column) -> Column:
    return F.trim(col, F.lit(WHITESPACE))


def _filled(template: str, placeholder: str, value: Column) -> Column:
    before, _, after = template.partition(placeholder)
    return F.concat(F.lit(before), value, F.lit(after))


def retrieval_prompt(query_text: Column) -> Column:
    return _filled(fv.RETRIEVAL_PROMPT, "{query}", query_text)


def _json_string(col: Column) -> Column:
    """A quoted, escaped JSON string, taken from a one-field object."""
    wrapped = F.to_json(F.struct(col.alias("s")), {"writeNonAsciiCharacterAsCodePoint": "true"})
    return F.substr(wrapped, F.lit(6), F.length(wrapped) - F.lit(6))


def annotation_context(image_id: Column, present: Column, box_count: Column) -> Column:
    """JSON context of one item, with a space after every colon and comma."""
    return F.concat(
        F.lit('{"image_id": '),
        _json_string(image_id),
        F.lit(', "ground_truth_drone_present": "'),
        F.when(present, "yes").otherwise("no"),
        F.lit('", "ground_truth_box_count": '),
        F.coalesce(box_count.cast("int"), F.lit(0)).cast("string"),
        F.lit("}"),
    )


def curation_prompt(image_id: Column, present: Column, box_count: Column) -> Column:
    return F.concat(
        F.lit(fv.CURATION_PROMPT + fv.CURATION_CONTEXT_HEADER),
        annotation_context(image_id, present, box_count),
    )


def content_b64(content: Column) -> Column:
    """Base64 on one line; Spark's own encoder breaks lines every 76 characters."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def cache_key(b64: Column, prompt: Column) -> Column:
    """Content-addressed key of an edit request."""
    digest = F.sha2(F.concat(b64, F.lit("|"), prompt).cast("binary"), 256)
    return F.substring(digest, 1, fv.CACHE_KEY_LENGTH)


def sample_key(seed: int, item_id: Column) -> Column:
    """Pseudo-random but reproducible order of items within a sample."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), item_id.cast("string")).cast("binary"))


def file_stem(path: Column) -> Column:
    """File name without directories and without its last suffix."""
    name = F.substring_index(path, "/", -1)
    return F.regexp_replace(name, r"(?s)^(.+)\.[^.]+$", "$1")


def file_suffix(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(name, r"(?s)^.+(\.[^.]+)$", 1))
