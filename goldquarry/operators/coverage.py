"""Coverage counts, gaps, cross-tabs with margins, facets and simple totals."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from goldquarry import fixed_values as fv
from goldquarry.functions.predicates import holds, presence_label, text_label

ALL = "All"
PRESENCE = "drone_present"


def split_counts(df: DataFrame) -> DataFrame:
    """Rows per split and presence."""
    return df.groupBy("source_split", PRESENCE).agg(F.count(F.lit(1)).alias("count"))


def totals(df: DataFrame) -> DataFrame:
    """Positives, negatives, rows with a sidecar file and all rows."""
    present = F.col(PRESENCE)
    return df.agg(
        F.count_if(holds(present)).alias("positives"),
        F.count_if(holds(~present)).alias("negatives"),
        F.count("xml_path").alias("with_xml"),
        F.count(F.lit(1)).alias("total"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def _parts(df: DataFrame, wanted: list[list[str]]):
    """Split wanted column groups into weighted tables: (table with `_n`, its groups).

    Groups of columns with a controlled vocabulary share a table of counted combinations,
    which is small however large `df` is. Groups with a free column are counted row by row.
    """
    controlled = [g for g in wanted if set(g) <= set(fv.CONTROLLED_COLUMNS)]
    free = [g for g in wanted if g not in controlled]
    if controlled:
        columns = sorted({c for g in controlled for c in g})
        yield df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), controlled
    if free:
        columns = sorted({c for g in free for c in g})
        yield df.select(*columns, F.lit(1).alias("_n")), free


def _is_array(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.ArrayType)


def _scalar_label(df: DataFrame, column: str, null_label: str) -> Column:
    col = F.col(column)
    if column == PRESENCE:
        return presence_label(col)
    label = text_label(col, df.schema[column].dataType.typeName())
    return F.coalesce(label, F.lit(null_label))


def _entries(df: DataFrame, column: str) -> Column:
    """Array of the (dimension, value) entries a row contributes to one dimension."""
    entry = lambda v: F.struct(F.lit(column).alias("dimension"), v.alias("value"))
    if not _is_array(df, column):
        return F.array(entry(_scalar_label(df, column, "unknown")))
    values = F.transform(F.col(column), lambda v: entry(F.coalesce(v.cast("string"), F.lit("unknown"))))
    return F.when(F.size(column) > 0, values).otherwise(F.array(entry(F.lit("none"))))


def coverage(
    df: DataFrame,
    dimensions=None,
    min_count: int = fv.COVERAGE_MIN_COUNT,
    domain: DataFrame | None = None,
) -> DataFrame:
    """Rows (dimension, value, count, has_gap), the dimensions counted together.

    Array columns count every element, so their totals may exceed the row count. Absent
    dimensions are skipped. A `domain` table (dimension, value) adds values never seen.
    """
    dimensions = fv.COVERAGE_DIMENSIONS if dimensions is None else dimensions
    known = [d for d in dimensions if d in df.columns]
    if not known:
        schema = "dimension string, value string, count bigint, has_gap boolean"
        return df.sparkSession.createDataFrame([], schema)
    tables = []
    for part, names in _parts(df, [[d] for d in known]):
        entries = F.concat(*[_entries(part, d) for (d,) in names])
        tables.append(
            part.select("_n", F.explode(entries).alias("e"))
            .groupBy("e.dimension", "e.value")
            .agg(F.sum("_n").alias("count"))
        )
    counts = reduce(DataFrame.unionByName, tables)
    if domain is not None:
        counts = domain.join(counts, ["dimension", "value"], "full").withColumn(
            "count", F.coalesce("count", F.lit(0))
        )
    return counts.withColumn("has_gap", F.col("count") < min_count)


def gaps(coverage_table: DataFrame, min_count: int = fv.COVERAGE_MIN_COUNT) -> DataFrame:
    """Coverage rows below the required count."""
    return (
        coverage_table.where(F.col("count") < min_count)
        .select("dimension", "value", "count")
        .withColumn("min_count", F.lit(min_count))
    )


def ranked(coverage_table: DataFrame) -> DataFrame:
    """Display order: per dimension by count, highest first, ties by value."""
    return coverage_table.orderBy("dimension", F.desc("count"), "value")


def _tab_label(df: DataFrame, column: str, null_label: str) -> Column:
    if _is_array(df, column):
        joined = F.array_join(column, ", ")
        return F.when(F.size(column) > 0, joined).otherwise("none")
    return _scalar_label(df, column, null_label)


def _with_margins(cells: DataFrame) -> DataFrame:
    """Add row, column and grand totals to (tab, l, r, n) cells.

    Runs over counted cells, so the rows of the table are expanded only once per tab.
    Margins are told from values by the grouping id, so a value named "All" stays apart.
    """
    shown = lambda c: F.when(F.grouping(c) == 1, ALL).otherwise(F.col(c))
    return (
        cells.groupingSets([["tab", "l", "r"], ["tab", "l"], ["tab", "r"], ["tab"]], "tab", "l", "r")
        .agg(
            shown("l").alias("left_value"),
            shown("r").alias("right_value"),
            (F.grouping("l") == 1).alias("left_margin"),
            (F.grouping("r") == 1).alias("right_margin"),
            F.sum("n").alias("count"),
        )
        .select("tab", "left_value", "right_value", "left_margin", "right_margin", "count")
    )


def crosstabs(df: DataFrame, pairs=None, null_label: str = "None") -> DataFrame:
    """Several cross-tabs with margins in long form, counted together.

    `pairs` holds (left, right, leave out rows without a visibility). Pairs with an absent
    column are skipped.
    """
    pairs = fv.KEY_CROSSTABS if pairs is None else pairs
    known = [p for p in pairs if p[0] in df.columns and p[1] in df.columns]
    if not known:
        schema = (
            "tab string, left_value string, right_value string, "
            "left_margin boolean, right_margin boolean, count bigint"
        )
        return df.sparkSession.createDataFrame([], schema)
    visibility = ["drone_visibility"] if "drone_visibility" in df.columns else []
    needs = {(l, r): visibility if seen else [] for l, r, seen in known}
    cells = []
    for part, names in _parts(df, [[l, r, *more] for (l, r), more in needs.items()]):
        entries = []
        for left, right, *seen in names:
            entry = F.struct(
                F.lit(f"{left}_x_{right}").alias("tab"),
                _tab_label(part, left, null_label).alias("l"),
                _tab_label(part, right, null_label).alias("r"),
            )
            entries.append(F.when(F.col(seen[0]).isNotNull(), entry) if seen else entry)
        cells.append(
            part.select("_n", F.explode(F.array_compact(F.array(*entries))).alias("e"))
            .groupBy("e.tab", "e.l", "e.r")
            .agg(F.sum("_n").alias("n"))
        )
    return _with_margins(reduce(DataFrame.unionByName, cells))


def crosstab(df: DataFrame, left: str, right: str, margins: bool = True, null_label: str = "None") -> DataFrame:
    """One cross-tab in long form (left_value, right_value, count), margins labelled "All"."""
    table = crosstabs(df, [(left, right, False)], null_label)
    if not margins:
        table = table.where(~F.col("left_margin") & ~F.col("right_margin"))
    return table.select("left_value", "right_value", "count")


def crosstab_tables(crosstabs: DataFrame) -> dict[str, DataFrame]:
    """Each cross-tab of a long form as a table: a column of row labels, one per value of the right side, and "All".

    The values are read from the long form, whose cells are combinations of controlled values, so its rows are few.
    Rows are sorted by label, the margin last.
    """
    listed = crosstabs.where("NOT right_margin").select("tab", "right_value").distinct()
    values: dict[str, list] = {r["tab"]: [] for r in crosstabs.select("tab").distinct().collect()}
    for row in listed.collect():
        values[row["tab"]].append(row["right_value"])
    tables = {}
    for tab, right in sorted(values.items()):
        cell = lambda v: F.sum(F.when(~F.col("right_margin") & (F.col("right_value") == v), F.col("count")))
        columns = [F.coalesce(cell(v), F.lit(0)).alias(v) for v in sorted(right)]
        total = F.sum(F.when(F.col("right_margin"), F.col("count"))).alias(ALL)
        label = F.when(F.col("left_margin"), ALL).otherwise(F.col("left_value")).alias(tab.split("_x_")[0])
        cells = crosstabs.where(F.col("tab") == tab).groupBy("left_margin", "left_value").agg(*columns, total)
        tables[tab] = cells.orderBy("left_margin", "left_value").select(label, *[F.col(f"`{v}`") for v in sorted(right)], ALL)
    return tables


def crosstab_wide(df: DataFrame, left: str, right: str, right_values, null_label: str = "None") -> DataFrame:
    """One cross-tab with a column per value of the right side and an "All" row and column.

    A value (or the null label) of the right side that `right_values` doesn't list is an error.
    """
    table = crosstabs(df, [(left, right, False)], null_label)
    in_cell = lambda v: F.sum(F.when(~F.col("right_margin") & (F.col("right_value") == v), F.col("count")))
    columns = [F.coalesce(in_cell(v), F.lit(0)).alias(v) for v in right_values]
    unlisted = ~F.col("right_margin") & ~F.col("right_value").isin(list(right_values))
    failed = F.raise_error(F.concat(F.lit(f"{right} has a value that is not listed: "), F.col("right_value"))).cast("long")
    total = F.sum(F.when(F.col("right_margin"), F.col("count")).when(unlisted, failed)).alias(ALL)
    return (
        table.groupBy("left_margin", F.col("left_value").alias(left))
        .agg(*columns, total)
        .drop("left_margin")
    )


def facet_values(df: DataFrame, facets=None) -> DataFrame:
    """Distinct shown values per facet column: sorted rows (facet, value)."""
    facets = fv.FACETS if facets is None else facets
    known = [[name] for name in facets if name in df.columns]
    tables = []
    for part, names in _parts(df, known):
        entries = []
        for (name,) in names:
            label = text_label(F.col(name), df.schema[name].dataType.typeName())
            shown = holds(~label.isin(facets[name])) if facets[name] else label.isNotNull()
            entries.append(F.when(shown, F.struct(F.lit(name).alias("facet"), label.alias("value"))))
        tables.append(
            part.select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
            .select("e.facet", "e.value")
            .distinct()
        )
    if not tables:
        return df.sparkSession.createDataFrame([], "facet string, value string")
    return reduce(DataFrame.unionByName, tables).orderBy("facet", "value")
