"""Reproducible samples: balanced two-class samples and the evaluation query set.

Random order is a hash of (seed, id), so a sample depends on neither partitioning nor row order.
The leading digits of the hash cut the table into slices of equal expected size. Counts per
slice, which a plain aggregate delivers, tell which slices a sample reaches; all other rows are
dropped before anything is sorted or shuffled. Slices that are taken whole are not ranked, and no
task ever holds a whole class.
"""

from hashlib import md5

from pyspark.sql import Column, DataFrame, Window, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.predicates import equals_all, holds
from goldquarry.functions.text import sample_key
from goldquarry.operators.bottom import bottom_n
from goldquarry.operators.joins import small_side

# Hex digits of the sample key that name a slice: of a query set, and of a balanced sample.
SLICE_DIGITS = 3
FINE_DIGITS = 4


def _with_key(df: DataFrame, key: str, seed: int, digits: int = SLICE_DIGITS) -> DataFrame:
    return df.withColumn("_key", sample_key(seed, F.col(key))).withColumn("_slice", F.substring("_key", 1, digits))


def _reached(counts: DataFrame, groups: list[str], order: list, quota: Column) -> DataFrame:
    """Slices (of `n` rows) a quota reaches, with the rows `left` to take from each.

    `counts` holds at most 16 ** SLICE_DIGITS rows per group.
    """
    upto = F.sum("n").over(Window.partitionBy(*groups).orderBy(*order))
    return (
        counts.where(F.col("n") > 0)
        .withColumn("left", quota - upto + F.col("n"))
        .where(F.col("left") > 0)
    )


def balanced_sample(
    df: DataFrame,
    class_col: str,
    max_rows: int,
    key: str = "image_id",
    seed: int = fv.SAMPLE_SEED,
) -> DataFrame:
    """At most `max_rows` rows, half from each class; an odd row goes to the positives.

    What one class cannot supply is taken from the other. Rows of unknown class are only
    returned when no sampling is needed (`max_rows` 0 or not below the row count).
    """
    if max_rows == 0:
        return df
    cls = F.col(class_col)
    name = F.when(cls, "pos").when(~cls, "neg").otherwise("unknown")
    rows = _with_key(df, key, seed, FINE_DIGITS).withColumn("_class", name)
    counts = rows.groupBy("_class", "_slice").agg(F.count(F.lit(1)).alias("n"))
    size = lambda c: F.coalesce(F.sum(F.when(F.col("_class") == c, F.col("n"))), F.lit(0))
    sizes = counts.agg(size("pos").alias("pos"), size("neg").alias("neg"), size("unknown").alias("unknown"))
    # Each class gets its half, or more where the other class falls short of its own.
    half = (max_rows + 1) // 2
    pos = F.least("pos", F.greatest(F.lit(half), F.lit(max_rows) - F.col("neg")))
    neg = F.least("neg", F.lit(max_rows) - pos)
    everything = F.col("pos") + F.col("neg") + F.col("unknown") <= max_rows
    share = lambda quota: F.when(everything, F.lit(max_rows)).otherwise(quota).cast("long")
    quotas = sizes.select(
        F.create_map(
            F.lit("pos"), share(pos), F.lit("neg"), share(neg), F.lit("unknown"), share(F.lit(0))
        )
    ).scalar()
    reached = _reached(counts, ["_class"], ["_slice"], F.element_at(quotas, F.col("_class")))
    # One row per class: the last slice it reaches and the rows to take from that; slices before it are taken whole.
    last = reached.groupBy("_class").agg(F.max(F.struct("_slice", "left", "n")).alias("_last"))
    taken = rows.join(F.broadcast(last), "_class")
    slice_, whole = F.col("_slice"), F.col("_last.n") <= F.col("_last.left")
    all_of_it = taken.where((slice_ < F.col("_last._slice")) | ((slice_ == F.col("_last._slice")) & whole))
    # The rest comes from one slice per class, a 65536th of its rows.
    in_slice = Window.partitionBy("_class").orderBy("_key", key)
    part = taken.where((slice_ == F.col("_last._slice")) & ~whole).withColumn("_rank", F.row_number().over(in_slice))
    part = part.where(F.col("_rank") <= F.col("_last.left"))
    return all_of_it.select(*df.columns).unionByName(part.select(*df.columns))


def usable_templates(df: DataFrame, templates=None) -> list:
    """Templates whose columns the table has."""
    templates = fv.QUERY_TEMPLATES if templates is None else templates
    return [t for t in templates if all(c in df.columns for c in t[2])]


def _flags(templates) -> dict[str, Column]:
    """One column per template: whether a row is a positive for it."""
    return {f"_t{i}": equals_all(values) for i, (_, _, values) in enumerate(templates)}


def _start(seed: int, query_id: str) -> str:
    """Slice at which a query starts to sample, so that queries do not share their frames."""
    return md5(f"{seed}|{query_id}".encode()).hexdigest()[:SLICE_DIGITS]


def _template_counts(profile: DataFrame, templates, seed: int) -> DataFrame:
    """Positives and negatives per template, from a row (or rows) of summed flags and `n`."""
    entries = [
        F.struct(
            F.lit(query_id).alias("query_id"),
            F.lit(query_text).alias("query_text"),
            F.lit(_start(seed, query_id)).alias("start"),
            F.col(f"_t{i}").alias("n_positive"),
            (F.col("n") - F.col(f"_t{i}")).alias("n_negative"),
        )
        for i, (query_id, query_text, _) in enumerate(templates)
    ]
    rest = [c for c in profile.columns if c == "_slice"]
    return profile.select(*rest, F.posexplode(F.array(*entries)).alias("position", "t")).select(
        *rest, "position", "t.*"
    )


def _tally(templates) -> list[Column]:
    hits = [F.count_if(flag).alias(name) for name, flag in _flags(templates).items()]
    return [*hits, F.count(F.lit(1)).alias("n")]


def template_eligibility(
    df: DataFrame,
    templates=None,
    n_queries: int = fv.QUERY_COUNT,
    n_samples: int = fv.QUERY_SAMPLES,
) -> DataFrame:
    """All templates with their counts, from one aggregate; the first `n_queries` eligible are chosen.

    Rows for which a template cannot be decided (nulls) count as negatives.
    """
    templates = usable_templates(df, templates)
    counts = _template_counts(df.agg(*_tally(templates)), templates, 0).drop("start")
    enough = (F.col("n_positive") >= n_samples) & (F.col("n_negative") >= n_samples)
    table = counts.withColumn("eligible", enough)
    # One row per template.
    chosen = table.where("eligible").orderBy("position").limit(n_queries).select("position", F.lit(True).alias("chosen"))
    return table.join(F.broadcast(chosen), "position", "left").withColumn(
        "chosen", F.coalesce("chosen", F.lit(False))
    )


def build_query_set(
    df: DataFrame,
    templates=None,
    n_queries: int = fv.QUERY_COUNT,
    n_samples: int = fv.QUERY_SAMPLES,
    seed: int = fv.SAMPLE_SEED,
    key: str = "image_id",
) -> DataFrame:
    """Long query set (query_id, query_text, image_id, is_positive).

    Each chosen template gets `n_samples` positives and as many negatives: the first ones in
    hash order from the query's start on. One aggregate counts all templates by slice; a second
    pass keeps the first ones of the reached slices in every task and merges them (`bottom_n`), so
    no slice is ranked. The result has at most `query_set_bound(...)` rows.
    """
    templates = usable_templates(df, templates)
    if not templates or n_queries == 0 or n_samples == 0:
        schema = "query_id string, query_text string, image_id string, is_positive boolean"
        return df.sparkSession.createDataFrame([], schema)
    flags = _flags(templates)
    rows = _with_key(
        df.select(F.col(key).alias("image_id"), *[c.alias(n) for n, c in flags.items()]), "image_id", seed
    )
    profile = rows.groupBy("_slice").agg(
        *[F.count_if(n).alias(n) for n in flags], F.count(F.lit(1)).alias("n")
    )
    # At most 16 ** SLICE_DIGITS rows per template from here to `reached`.
    counts = _template_counts(profile, templates, seed)
    enough = (F.sum("n_positive") >= n_samples) & (F.sum("n_negative") >= n_samples)
    chosen = (
        counts.groupBy("position").agg(enough.alias("eligible")).where("eligible").orderBy("position").limit(n_queries)
    )
    sides = F.array(
        F.struct(F.lit(True).alias("is_positive"), F.col("n_positive").alias("n")),
        F.struct(F.lit(False).alias("is_positive"), F.col("n_negative").alias("n")),
    )
    by_class = counts.join(F.broadcast(chosen), "position", "left_semi").select(
        "_slice", "position", "start", F.inline(sides)
    )
    order = [F.col("_slice") < F.col("start"), F.col("_slice")]
    reached = (
        _reached(by_class, ["position", "is_positive"], order, F.lit(n_samples))
        .groupBy("_slice")
        .agg(F.collect_list(F.struct("position", "is_positive")).alias("takes"))
    )
    most = 16**SLICE_DIGITS * query_set_bound(min(n_queries, len(templates)), 1)
    fits = F.filter(
        "takes", lambda t: F.get(F.array(*flags), t["position"]) == t["is_positive"]
    )
    starts = F.array(*[F.lit(_start(seed, t[0])) for t in templates])
    members = (
        rows.join(small_side(reached, most), "_slice")
        .select("_slice", "_key", "image_id", F.explode(fits).alias("t"))
        .select(
            "t.position",
            "t.is_positive",
            # Keys from the query's start on come before those that lie before it.
            F.concat(F.when(F.col("_slice") < F.get(starts, F.col("t.position")), "1").otherwise("0"), "_key").alias("_at"),
            "image_id",
        )
    )
    picked = bottom_n(members, ["position", "is_positive"], ["_at", "image_id"], n_samples)
    named = lambda part: F.get(F.array(*[F.lit(t[part]) for t in templates]), F.col("position"))
    return picked.select(named(0).alias("query_id"), named(1).alias("query_text"), "image_id", "is_positive")


def query_set_bound(n_queries: int = fv.QUERY_COUNT, n_samples: int = fv.QUERY_SAMPLES) -> int:
    """Largest possible number of rows of a built query set."""
    return 2 * n_queries * n_samples


def query_set_nested(query_set: DataFrame) -> DataFrame:
    """One row per query with its positive and negative id lists and the combined list.

    The list sizes are the sample sizes of the query set.
    """
    ids = lambda wanted: F.array_sort(
        F.collect_list(F.when(F.col("is_positive") == wanted, F.col("image_id")))
    )
    return (
        query_set.groupBy("query_id", "query_text")
        .agg(ids(True).alias("positive_ids"), ids(False).alias("negative_ids"))
        .withColumn("all_ids", F.concat("positive_ids", "negative_ids"))
    )


def with_models(df: DataFrame, models) -> DataFrame:
    """Every row once per model name."""
    return df.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def eval_plan(query_set: DataFrame, models) -> DataFrame:
    """Size of a scoring run: models, queries, frames and calls."""
    return query_set.agg(
        F.lit(len(models)).cast("long").alias("n_models"),
        F.count_distinct("query_id").alias("n_queries"),
        F.count(F.lit(1)).alias("n_frames"),
        (F.count(F.lit(1)) * F.lit(len(models))).alias("n_calls"),
    )
