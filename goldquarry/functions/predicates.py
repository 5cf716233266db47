"""Two-valued predicates and the string labels that stand for booleans and nulls."""

from pyspark.sql import Column, functions as F

from goldquarry import fixed_values as fv


def holds(predicate: Column) -> Column:
    """A predicate that is false, not null, when an operand is null, so it can be negated."""
    return F.coalesce(predicate, F.lit(False))


def has_value(col: Column) -> Column:
    """False for null, NaN and the strings that stand for a missing value."""
    return holds(~F.lower(col.cast("string")).isin(fv.MISSING_STRINGS))


def within(col: Column, low: float | None, high: float | None) -> Column:
    """Inclusive range that lets nulls pass; a bound of None is not checked."""
    checks = F.lit(True)
    if low is not None:
        checks = checks & (col >= F.lit(low))
    if high is not None:
        checks = checks & (col <= F.lit(high))
    # Spark orders NaN above every number; a missing statistic passes either way.
    missing = col.isNull() | F.isnan(col.cast("double"))
    return missing | checks


def not_excluded(col: Column, excluded) -> Column:
    """True unless the value is on the exclusion list; nulls pass."""
    if not excluded:
        return F.lit(True)
    return col.isNull() | ~col.isin(list(excluded))


def presence_label(col: Column) -> Column:
    return F.when(col, "yes").when(~col, "no").otherwise("uncertain")


def text_label(col: Column, dtype: str) -> Column:
    """String form of a scalar; booleans read True / False."""
    return F.initcap(col.cast("string")) if dtype == "boolean" else col.cast("string")


def equals_all(values: dict) -> Column:
    """Conjunction of column = value tests, false where a column is null."""
    test = F.lit(True)
    for name, value in values.items():
        test = test & (F.col(name) == F.lit(value))
    return holds(test)
