"""Quality filters, facet filters, descriptive statistics and histograms."""

from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Window, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.predicates import holds, not_excluded, text_label, within


# Approximate quantiles are taken this far from a wanted one, on either side.
MARGIN = 0.002
# Rows that one task orders to find a quantile, at most.
SLICE_ROWS = 20_000


def quality_predicate(columns, ranges=None, exclude=None) -> Column:
    """Conjunction of null-passing range and exclusion tests on the columns that are present."""
    ranges = fv.QUALITY_RANGES if ranges is None else ranges
    exclude = fv.QUALITY_EXCLUSIONS if exclude is None else exclude
    test = F.lit(True)
    for name, (low, high) in ranges.items():
        if name in columns:
            test = test & within(F.col(name), low, high)
    for name, values in exclude.items():
        if name in columns:
            test = test & not_excluded(F.col(name), values)
    return test


def quality_filter(df: DataFrame, ranges=None, exclude=None) -> DataFrame:
    return df.where(quality_predicate(df.columns, ranges, exclude))


def kept_dropped(df: DataFrame, predicate: Column) -> DataFrame:
    """Kept, dropped and total row counts of a filter, in one aggregate."""
    keep = holds(predicate)
    return df.agg(
        F.count_if(keep).alias("kept"),
        F.count_if(~keep).alias("dropped"),
        F.count(F.lit(1)).alias("total"),
    )


def facet_predicate(df: DataFrame, choices: dict) -> Column:
    """Conjunction of the chosen facet values; None, "", "All" and absent columns do not filter."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    test = F.lit(True)
    for name, choice in choices.items():
        if choice in (None, "", "All") or name not in kinds:
            continue
        label = F.coalesce(text_label(F.col(name), kinds[name]), F.lit("None"))
        test = test & (label == F.lit(str(choice)))
    return test


def facet_filter(df: DataFrame, choices: dict) -> DataFrame:
    """Rows matching every chosen facet value; `kept_dropped` with the predicate counts them."""
    return df.where(facet_predicate(df, choices))


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns of a row that can be hashed."""
    return F.xxhash64(*[f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")])


def first_n(df: DataFrame, n: int, key: str = "image_id") -> DataFrame:
    """The first n rows by key, null keys first; 0 means all rows.

    Rows with the same key follow each other by a hash of the whole row, so the choice depends on
    nothing but the rows. One plan for every n, and nothing runs while it is built: every task keeps
    its first n rows, and one takes the first n of those. n is a cap on rows that people look at or
    pay for; a share of a large table is what `sampling.balanced_sample` is for.
    """
    if n == 0:
        return df
    return df.orderBy(F.col(key).asc_nulls_first(), row_hash(df)).limit(n)


def _long(df: DataFrame, columns: dict) -> DataFrame:
    """Rows (stat, v) of the non-missing values of each column."""
    pairs = [
        F.struct(F.lit(name).alias("stat"), col.cast("double").alias("v"))
        for name, col in columns.items()
    ]
    long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.stat", "p.v")
    return long.where(F.col("v").isNotNull() & ~F.isnan("v"))


def _as_columns(columns) -> dict:
    return columns if isinstance(columns, dict) else {c: F.col(c) for c in columns}


def _numbers(df: DataFrame, columns: dict) -> DataFrame:
    """The columns as doubles, NaN read as missing."""
    clean = {n: F.nanvl(c.cast("double"), F.lit(None).cast("double")) for n, c in columns.items()}
    return df.select(*[c.alias(n) for n, c in clean.items()])


def _summary(numbers: DataFrame, marks: list[float]) -> dict[str, dict]:
    """Moments and approximate quantiles at the marks per column with values: one small row."""
    at = F.array(*map(F.lit, marks))
    per_column = [
        F.struct(
            F.count(c).alias("count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            F.max(c).alias("max"),
            F.percentile_approx(c, at, F.lit(1000)).alias("cuts"),
        ).alias(c)
        for c in numbers.columns
    ]
    row = numbers.agg(*per_column).first()
    return {c: row[c].asDict() for c in numbers.columns if row[c]["count"]}


def _marks(probabilities, margin: float) -> list[float]:
    return sorted({min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-margin, margin)})


def _sliced(cuts: list, low, high, counts, before: int, upto: int) -> list[tuple]:
    """Slices (low, high, rows before, rows upto) of an open interval cut at values inside it.

    A cut itself is a slice with low == high, so a value that many rows share is no part of any
    interval. `counts` gives, cut by cut, the rows below it and up to it.
    """
    slices, start, below = [], low, before
    for cut in cuts:
        less, most = next(counts), next(counts)
        slices += [(start, cut, below, less), (cut, cut, less, most)]
        start, below = cut, most
    return [*slices, (start, high, below, upto)]


def _cuts_inside(numbers: DataFrame, open_slices: list, margin: float) -> list[list]:
    """Approximate quantiles around the ranks of each slice (column, low, high, before, upto, ranks), by one aggregate."""
    cuts = []
    for i, (c, low, high, before, upto, ranks) in enumerate(open_slices):
        size = max(upto - before - 1, 1)
        at = F.array(*map(F.lit, _marks([(r - before) / size for r in ranks], margin)))
        cuts.append(F.percentile_approx(F.when(_inside(F.col(c), low, high), F.col(c)), at, F.lit(1000)).alias(f"c{i}"))
    return list(numbers.agg(*cuts).first())


def _counted(numbers: DataFrame, open_slices: list, cuts: list[list]) -> list[list]:
    """The parts of each open slice, cut at values inside it; one aggregate counts the rows up to all cuts."""
    cuts = [sorted(set(values)) for values in cuts]
    ends = [
        F.count_if(_inside(F.col(c), low, high) & test)
        for (c, low, high, *_), at in zip(open_slices, cuts)
        for x in at
        for test in (F.col(c) < x, F.col(c) <= x)
    ]
    counted = iter(numbers.agg(*[n.alias(f"n{i}") for i, n in enumerate(ends)]).first())
    parts = []
    for (_, low, high, before, upto, _), at in zip(open_slices, cuts):
        parts.append(_sliced(at, low, high, (before + next(counted) for _ in range(2 * len(at))), before, upto))
    return parts


def _narrowed(numbers: DataFrame, summary: dict, ranks: dict[str, set], margin: float) -> dict[str, list]:
    """Per column the slices that hold its wanted ranks: single values, or intervals of at most SLICE_ROWS rows.

    Distributed selection in rounds: a slice with more rows is cut again by its own quantiles. Every round
    leaves a few permille of a slice and takes its cuts out of it, so three or four rounds do for any table.
    """
    done = {c: [] for c in ranks}
    todo = [(c, None, None, 0, summary[c]["count"], ranks[c]) for c in ranks]
    cuts = [summary[c]["cuts"] for c in ranks]
    while todo:
        again = []
        for (c, *_, wanted), parts in zip(todo, _counted(numbers, todo, cuts)):
            for low, high, before, upto in parts:
                held = {r for r in wanted if before <= r < upto}
                if held and upto - before > SLICE_ROWS and not (low is not None and low == high):
                    again.append((c, low, high, before, upto, held))
                elif held:
                    done[c].append((low, high, before, upto))
        todo = again
        cuts = _cuts_inside(numbers, todo, MARGIN) if todo else []
    return done


def _inside(col: Column, low, high) -> Column:
    test = F.lit(True) if low is None else col > low
    return test if high is None else test & (col < high)


def quantiles(df: DataFrame, columns, probabilities, margin: float = MARGIN) -> DataFrame:
    """Exact quantiles with linear interpolation: rows (stat, q, value).

    Stays exact and distributed on columns of any size. Approximate quantiles a little below
    and above every wanted one cut the values into slices, and one aggregate counts the rows up
    to each cut (both give a few numbers, which are read at once). The counts tell which slices
    hold the wanted ranks. A slice of more than SLICE_ROWS rows is cut again in the same way, until
    what is shuffled and ordered is a bounded number of rows, whatever the table's size. The cuts
    affect the work, never the result.
    """
    numbers = _numbers(df, _as_columns(columns))
    return _quantiles(numbers, _summary(numbers, _marks(probabilities, margin)), probabilities, margin)


def _quantiles(numbers: DataFrame, summary: dict, probabilities, margin: float = MARGIN) -> DataFrame:
    spark = numbers.sparkSession
    if not summary:
        return spark.createDataFrame([], "stat string, q double, value double")
    # At most two ranks per column and quantile: found at a cut, or still to be looked up.
    found, wanted, places = [], [], {}
    at = {c: [(p, p * (s["count"] - 1)) for p in map(float, probabilities)] for c, s in summary.items()}
    whole = lambda pos: {floor(pos), ceil(pos)}
    ranks_of = {c: set().union(*(whole(pos) for _, pos in positions)) for c, positions in at.items()}
    for c, slices in _narrowed(numbers, summary, ranks_of, margin).items():
        positions = at[c]
        for k, (low, high, before, upto) in enumerate(slices):
            ranks = [
                (c, k, p, pos - floor(pos), r - before)
                for p, pos in positions
                for r in whole(pos)
                if before <= r < upto
            ]
            if ranks and low is not None and low == high:
                found += [(c, p, fraction, low) for _, _, p, fraction, _ in ranks]
            elif ranks:
                wanted += ranks
                start = F if c not in places else places[c]
                places[c] = start.when(_inside(F.col(c), low, high), k)
    values = spark.createDataFrame(found, "stat string, q double, fraction double, v double")
    if wanted:
        values = values.unionByName(_values_at(numbers, places, wanted))
    low, high = F.min("v"), F.max("v")
    return values.groupBy("stat", "q").agg((low + (high - low) * F.first("fraction")).alias("value"))


def _values_at(numbers: DataFrame, places: dict[str, Column], wanted: list) -> DataFrame:
    """Values at wanted ranks (column, slice, q, fraction, rank in slice)."""
    ranks = numbers.sparkSession.createDataFrame(
        wanted, "stat string, slice int, q double, fraction double, rank long"
    )
    entries = [
        F.when(place.isNotNull(), F.struct(F.lit(c).alias("stat"), place.alias("slice"), F.col(c).alias("v")))
        for c, place in places.items()
    ]
    near = reduce(Column.__or__, [place.isNotNull() for place in places.values()])
    by_value = Window.partitionBy("stat", "slice").orderBy("v")
    ordered = (
        numbers.where(near)
        .select(F.explode(F.array_compact(F.array(*entries))).alias("e"))
        .groupBy("e.stat", "e.slice", "e.v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(by_value))
    )
    hit = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    return (
        ordered.join(F.broadcast(ranks), ["stat", "slice"]).where(hit).select("stat", "q", "fraction", "v")
    )


def describe(df: DataFrame, columns, digits: int = 3) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, missing values skipped.

    A column without values has count 0 and nulls.
    """
    quartiles = [0.25, 0.5, 0.75]
    numbers = _numbers(df, _as_columns(columns))
    summary = _summary(numbers, _marks(quartiles, MARGIN))
    # One row per column.
    empty = dict.fromkeys(("mean", "std", "min", "max")) | {"count": 0}
    basics = numbers.sparkSession.createDataFrame(
        [(c, *[summary.get(c, empty)[k] for k in ("count", "mean", "std", "min", "max")]) for c in numbers.columns],
        "stat string, count long, mean double, std double, min double, max double",
    )
    at = lambda p: F.max(F.when(F.col("q") == p, F.col("value")))
    inner = (
        _quantiles(numbers, summary, quartiles)
        .groupBy("stat")
        .agg(at(0.25).alias("p25"), at(0.5).alias("p50"), at(0.75).alias("p75"))
    )
    columns_out = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return basics.join(F.broadcast(inner), "stat", "left").select(
        "stat", "count", *[F.round(c, digits).alias(c) for c in columns_out]
    )


def histogram(df: DataFrame, columns, bins: int = fv.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram per column: rows (stat, bin, low, high, count), empty bins included.

    The last bin is closed; a constant column gets a range of one around its value.
    """
    long = _long(df, _as_columns(columns))
    flat = F.col("lo") == F.col("hi")
    # One row per column.
    spans = (
        long.groupBy("stat")
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
        .select(
            "stat",
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    place = F.floor((F.col("v") - F.col("lo")) * float(bins) / (F.col("hi") - F.col("lo"))) + 1
    counts = (
        long.join(F.broadcast(spans), "stat")
        .withColumn("bin", F.least(place, F.lit(bins)).cast("int"))
        .groupBy("stat", "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    width = (F.col("hi") - F.col("lo")) / float(bins)
    # At most `bins` rows per column on both sides.
    return (
        spans.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
        .join(F.broadcast(counts), ["stat", "bin"], "left")
        .select(
            "stat",
            "bin",
            (F.col("lo") + width * (F.col("bin") - 1)).alias("low"),
            (F.col("lo") + width * F.col("bin")).alias("high"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
    )
