"""Label edits: parsing of edit forms and keyed upserts."""

from pyspark.sql import Column, DataFrame, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.labels import retrieved
from goldquarry.functions.text import strip_space
from goldquarry.operators.joins import unique_rows


def _default(name: str) -> Column:
    value = fv.EDIT_DEFAULTS[name]
    return F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)


def parse_edits(forms: DataFrame) -> DataFrame:
    """Typed edits from string form fields: comma lists, digits and booleans are converted."""
    empty_to_null = lambda c: F.when(c != "", c)
    items = F.filter(
        F.transform(F.split("possible_confusers", ","), strip_space), lambda v: v != ""
    )
    typed = {
        "drone_present": F.coalesce(F.lower("drone_present") == "true", F.lit(False)),
        "possible_confusers": F.when(F.size(items) > 0, items),
        "score": F.when(F.col("score").rlike("^[0-9]+$"), F.col("score").try_cast("int")),
    }
    for name in fv.EDIT_DEFAULTS:
        if name not in typed:
            typed[name] = empty_to_null(F.col(name))
    return forms.withColumns(typed)


def apply_edits(
    df: DataFrame, edits: DataFrame, keys=("image_id",), last_by: str | None = None
) -> DataFrame:
    """Overwrite the editable columns of every row an edit names; other rows stay as they are.

    An empty field of an edit stores the field's default. Evaluation rows are edited by
    (model, query_id, image_id); a changed score also updates `retrieved` and `correct`.
    Several edits of one row are an error unless `last_by` names the column that orders them.
    """
    keys = list(keys)
    fields = [n for n in fv.EDIT_DEFAULTS if n in df.columns and n in edits.columns]
    named = edits.select(
        F.struct(*keys).alias("_key"),
        F.struct(*[F.coalesce(F.col(n), _default(n)).alias(n) for n in fields]).alias("_edit"),
        *([F.col(last_by).alias("_order")] if last_by else []),
    )
    lookup = unique_rows(named, "_key", "_order" if last_by else None)
    lookup = lookup.select(*[F.col("_key")[k].alias(k) for k in keys], "_edit")
    edited = F.col("_edit").isNotNull()
    columns = {n: F.when(edited, F.col("_edit")[n]).otherwise(F.col(n)) for n in fields}
    out = df.join(lookup, keys, "left").withColumns(columns)
    if {"score", "retrieved", "correct", "is_positive"} <= set(df.columns) and "score" in fields:
        hit = F.coalesce(retrieved(F.col("score")), F.lit(False))
        out = out.withColumns(
            {
                "retrieved": F.when(edited, hit).otherwise(F.col("retrieved")),
                "correct": F.when(edited, hit == F.col("is_positive")).otherwise(F.col("correct")),
            }
        )
    return out.select(*df.columns)


def unmatched_edits(df: DataFrame, edits: DataFrame, keys=("image_id",)) -> DataFrame:
    """Keys of edits that name no row."""
    keys = list(keys)
    return edits.select(*keys).distinct().join(df.select(*keys).distinct(), keys, "left_anti")
