"""Extraction of the answer object from free model text."""

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from goldquarry.functions.text import strip_space


def with_answer_text(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add the model text without reasoning blocks and without a surrounding code fence.

    One column per step, so that no pattern is applied twice.
    """
    whole, outside, text, opened = (f"_{out}_{step}" for step in range(4))
    unfenced = F.when(
        F.col(opened).endswith("```"),
        strip_space(F.substr(opened, F.lit(1), F.length(opened) - F.lit(3))),
    ).otherwise(F.col(opened))
    return (
        df.withColumn(whole, strip_space(F.col(text_col)))
        .withColumn(outside, strip_space(F.regexp_replace(whole, r"(?s)<think>.*?</think>", "")))
        .withColumn(text, F.when(F.col(outside) != "", F.col(outside)).otherwise(F.col(whole)))
        .withColumn(opened, strip_space(F.regexp_replace(text, r"(?i)^```(?:json)?", "")))
        .withColumn(out, F.when(F.col(text).startswith("```"), unfenced).otherwise(F.col(text)))
        .drop(whole, outside, text, opened)
    )


# Bytes whose structure is looked at together.
SLICE_BYTES = 1 << 20
QUOTE, BACKSLASH, OPEN, CLOSE = b'"\\{}'


def _per_text(values: np.ndarray, first: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Running sums of `values`, starting anew with each text; text t has first[t] .. first[t + 1]."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[1:] - sums[first[text]]


def object_spans(data: np.ndarray, offsets: np.ndarray):
    """(text, start, end) of every pair of matching braces, sorted by text and start.

    An object that begins at a brace sees the quotes behind it only. So braces are taken apart by whether the
    number of quotes before them in the text is even or odd: those of the brace's own kind are outside of its
    strings. In each kind the running depth tells which closing brace ends an opening one: the next of its depth.
    A quote behind an odd number of backslashes is none. Whatever parses as an object ends at its match.
    """
    quotes = np.flatnonzero(data == QUOTE)
    slashes = np.flatnonzero(data == BACKSLASH)
    if len(slashes) and len(quotes):
        # Backslashes in a row, counted up to each; rows end with their text.
        new = np.ones(len(slashes), bool)
        new[1:] = (np.diff(slashes) > 1) | (np.diff(np.searchsorted(offsets, slashes, "right")) > 0)
        start = np.maximum.accumulate(np.where(new, np.arange(len(slashes)), 0))
        odd = slashes[(np.arange(len(slashes)) - start) % 2 == 0]
        inside = ~np.isin(quotes, offsets)  # the first byte of a text has nothing before it
        quotes = quotes[~(inside & np.isin(quotes - 1, odd))]
    braces = np.flatnonzero((data == OPEN) | (data == CLOSE))
    text = np.searchsorted(offsets, braces, "right") - 1
    opens = data[braces] == OPEN
    kind = (np.searchsorted(quotes, braces) - np.searchsorted(quotes, offsets[text])) % 2
    found = []
    for k in (0, 1):
        here = kind == k
        at, of, up = braces[here], text[here], opens[here]
        depth = _per_text(np.where(up, 1, -1), np.searchsorted(of, np.arange(len(offsets))), of)
        level = np.where(up, depth, depth + 1)
        order = np.lexsort((at, level, of))
        at, of, up, level = at[order], of[order], up[order], level[order]
        pair = np.flatnonzero(up[:-1] & ~up[1:] & (of[1:] == of[:-1]) & (level[1:] == level[:-1]))
        found.append(np.stack([of[pair], at[pair], at[pair + 1] + 1], 1))
    spans = np.concatenate(found)
    return spans[np.lexsort((spans[:, 1], spans[:, 0]))]


def _parsed(data: bytes) -> str | None:
    try:
        return json.dumps(json.loads(data))
    except (ValueError, RecursionError):
        return None


def _last_of(spans: np.ndarray, data: np.ndarray) -> str | None:
    """The last object of a text's spans, read from left to right; spans inside an object don't count."""
    covered = np.maximum.accumulate(np.concatenate([[0], spans[:-1, 2]]))
    outer = spans[:, 2] > covered
    crossing = outer & (spans[:, 1] < covered)
    if not crossing.any():
        # Mostly the last of the outermost spans is an object: then it is the one, and nothing else is read.
        _, start, end = spans[np.flatnonzero(outer)[-1]]
        last = _parsed(data[start:end].tobytes())
        if last is not None:
            return last
    found, upto = None, 0
    for _, start, end in spans.tolist():
        if start >= upto:
            read = _parsed(data[start:end].tobytes())
            if read is not None:
                found, upto = read, end
    return found


def last_objects(texts: pa.Array) -> pa.Array:
    """The last top-level JSON object of each text, re-serialised; null if there is none."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    out: list[str | None] = [None] * n
    row = 0
    while row < n:
        end = min(max(int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1, row + 1), n)
        # Empty texts at the end of a slice share an offset; texts are told apart by those that have bytes.
        full = row + np.flatnonzero(np.diff(offsets[row : end + 1]))
        if len(full):
            part = data[offsets[row] : offsets[end]]
            begins = np.append(offsets[full], offsets[end]) - offsets[row]
            spans = object_spans(part, begins)
            cuts = np.searchsorted(spans[:, 0], np.arange(len(full) + 1))
            for t in np.flatnonzero(np.diff(cuts)).tolist():
                out[full[t]] = _last_of(spans[cuts[t] : cuts[t + 1]], part)
        row = end
    return pa.array(out, pa.string())


@F.arrow_udf(StringType())
def _scan(texts: pa.Array) -> pa.Array:
    return last_objects(texts)


def extract_json(df: DataFrame, text_col: str) -> DataFrame:
    """Add `json` (the answer object as text) and `parse_status` (ok / no_object).

    A text that is one flat object is taken as it is inside the JVM. Everything else (nested
    objects, arrays, surrounding prose, several fragments, non-standard numbers) goes through a
    structural index over the Arrow bytes, and only the span of the chosen object is parsed; flat rows
    reach it as nulls.
    """
    text = F.col("_answer")
    flat = text.rlike(r"^\{[^{}]*\}$") & F.try_parse_json(text).isNotNull()
    return (
        with_answer_text(df, text_col, "_answer")
        .withColumn("_flat", F.coalesce(flat, F.lit(False)))
        .withColumn("_scanned", _scan(F.when(~F.col("_flat"), text)))
        .withColumn("json", F.when(F.col("_flat"), text).otherwise(F.col("_scanned")))
        .withColumn("parse_status", F.when(F.col("json").isNull(), "no_object").otherwise("ok"))
        .drop("_answer", "_flat", "_scanned")
    )
