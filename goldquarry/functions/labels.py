"""Normalisation of labels and graded answers into controlled vocabularies."""

from pyspark.sql import Column, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.text import strip_space


def coerce_enum(col: Column, domain, default: str) -> Column:
    """The value if it is in the vocabulary (exact match), else the default."""
    return F.when(col.isin(list(domain)), col).otherwise(F.lit(default))


def coerce_labels(
    col: Column,
    allowed=tuple(fv.CONFUSERS),
    aliases=None,
    none_label: str = "none",
) -> Column:
    """Clean a free label list: known labels only, sorted and distinct, ``[none]`` if none is left."""
    aliases = fv.CONFUSER_ALIASES if aliases is None else aliases
    real = [a for a in allowed if a != none_label]

    def clean(item):
        key = F.rtrim(F.lower(strip_space(item)), F.lit(fv.CONFUSER_TRAILING_PUNCTUATION))
        if not aliases:
            return key
        named = None
        for alias, label in aliases.items():
            named = F.when(key == alias, label) if named is None else named.when(key == alias, label)
        return named.otherwise(key)

    kept = F.array_sort(
        F.array_distinct(F.filter(F.transform(col, clean), lambda k: k.isin(real)))
    )
    return F.when(F.size(kept) > 0, kept).otherwise(F.array(F.lit(none_label)))


def curation_status(confusers: Column) -> Column:
    """Rows with a possible confuser need review."""
    suspicious = (F.size(confusers) > 0) & (confusers != F.array(F.lit("none")))
    return F.when(suspicious, "needs_review").otherwise("keep")


def grade(raw: Column) -> Column:
    """Struct (graded_response, score) of a free-text answer.

    The longest phrase contained in the answer wins; an answer without a phrase, and a
    failed call (null), count as uncertain.
    """
    answer = F.lower(F.coalesce(raw, F.lit("")))
    phrase = F.lit(fv.GRADE_DEFAULT)
    for text in sorted(fv.GRADES, key=len):
        phrase = F.when(answer.contains(text), text).otherwise(phrase)
    return F.struct(phrase.alias("graded_response"), score_of(phrase).alias("score"))


def score_of(phrase: Column) -> Column:
    score = None
    for text, value in fv.GRADES.items():
        hit = F.lit(value)
        score = F.when(phrase == text, hit) if score is None else score.when(phrase == text, hit)
    return score


def retrieved(score: Column, threshold: int = fv.RETRIEVAL_THRESHOLD) -> Column:
    return score >= F.lit(threshold)


def condition(label: Column, augmentation_type: Column) -> Column:
    """Evaluation condition: variant label, else the name of the augmentation, else original."""
    by_type = None
    for kind, name in fv.CONDITION_BY_TYPE.items():
        test = augmentation_type == kind
        by_type = F.when(test, name) if by_type is None else by_type.when(test, name)
    return F.coalesce(label, by_type, F.lit(fv.CONDITION_DEFAULT))


def recode(col: Column, mapping: dict, otherwise: Column) -> Column:
    """Value mapping with a fallback column for everything unmapped."""
    out = None
    for key, value in mapping.items():
        out = F.when(col == key, F.lit(value)) if out is None else out.when(col == key, F.lit(value))
    return otherwise if out is None else out.otherwise(otherwise)
