"""Confusion counts, precision / recall / F1, run summaries and evaluation matrices."""

from pyspark.sql import Column, DataFrame, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.labels import condition
from goldquarry.operators.joins import small_side, unique_rows
from goldquarry.operators.sampling import with_models

METRICS = ["precision", "recall", "f1"]


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _confusion() -> dict[str, Column]:
    positive, hit = F.col("is_positive"), F.col("retrieved")
    return {
        "tp": F.count_if(positive & hit),
        "fp": F.count_if(~positive & hit),
        "fn": F.count_if(positive & ~hit),
        "tn": F.count_if(~positive & ~hit),
    }


def with_metrics(df: DataFrame, digits: int) -> DataFrame:
    """Add rounded precision, recall and F1 to confusion counts; zero denominators give 0."""
    precision = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    f1 = _ratio(precision * recall * 2, precision + recall)
    rounded = [F.round(m, digits).alias(n) for m, n in zip((precision, recall, f1), METRICS)]
    return df.select("*", *rounded)


def query_metrics(results: DataFrame, query_set: DataFrame, models, digits: int = 4) -> DataFrame:
    """Metrics per model and query. Sizes are the planned ones, also where frames were skipped."""
    planned = with_models(
        query_set.groupBy("query_id", "query_text").agg(
            F.count_if("is_positive").alias("n_positive"),
            F.count_if(~F.col("is_positive")).alias("n_negative"),
        ),
        models,
    )
    counts = _confusion()
    scored = results.groupBy("model", "query_id").agg(*[c.alias(n) for n, c in counts.items()])
    table = planned.join(scored, ["model", "query_id"], "left").na.fill(0, list(counts))
    return with_metrics(table, digits).select(
        "model", "query_id", "query_text", "n_positive", "n_negative", *counts, *METRICS
    )


def run_summary(metrics: DataFrame, digits: int = 4, nested: bool = True) -> DataFrame:
    """One row per model: macro means over the queries and, if `nested`, their metrics as a list.

    Leave the list out for very large custom query sets; `metrics` has the same rows.
    """
    fields = ["query_id", "query_text", "n_positive", "n_negative", "tp", "fp", "fn", "tn", *METRICS]
    per_query = F.array_sort(F.collect_list(F.struct(*fields))).alias("per_query")
    return metrics.groupBy("model").agg(
        F.lit(fv.RETRIEVAL_THRESHOLD).alias("retrieval_threshold"),
        F.count(F.lit(1)).alias("n_queries"),
        *[F.round(F.avg(m), digits).alias(f"mean_{m}") for m in METRICS],
        *([per_query] if nested else []),
    )


def detailed_eval(
    results: DataFrame,
    queries: DataFrame,
    items: DataFrame,
    drop=tuple(fv.HEAVY_COLUMNS),
    max_rows: int | None = None,
) -> DataFrame:
    """Results with query text (the id where unknown) and the light columns of their items.

    The item table is reduced to the scored ids before it is joined, so only those rows move. If an id
    repeats, the row with the largest path counts, as in scoring; without paths it is an error.
    `max_rows` is a proven bound on the number of results, if there is one.
    """
    base = ["model", "query_id", "image_id", "is_positive", "graded_response", "score", "retrieved"]
    texts = unique_rows(queries.select("query_id", "query_text").distinct(), "query_id", "query_text")
    light = [c for c in items.columns if c not in drop and (c == "image_id" or c not in base)]
    light = [c for c in light if c not in ("query_text", "correct")]
    scored = small_side(results.select("image_id").distinct(), max_rows)
    path = [c for c in ("image_path",) if c in items.columns and c not in light]
    found = items.select(*light, *path).join(scored, "image_id", "left_semi")
    last_by = "image_path" if "image_path" in found.columns else None
    meta = unique_rows(found, "image_id", last_by).drop(*path)
    return (
        results.select(*base)
        .join(texts, "query_id", "left")
        .withColumn("query_text", F.coalesce("query_text", "query_id"))
        .withColumn("correct", F.col("retrieved") == F.col("is_positive"))
        .join(meta, "image_id", "left")
        .select(
            "model",
            "query_id",
            "query_text",
            *base[2:],
            "correct",
            *[c for c in light if c != "image_id"],
        )
    )


def with_condition(eval_df: DataFrame) -> DataFrame:
    """Add the evaluation condition; absent source columns count as null."""
    col = lambda n: F.col(n) if n in eval_df.columns else F.lit(None).cast("string")
    return eval_df.withColumn("condition", condition(col("augment_label"), col("augmentation_type")))


def metrics_by(eval_df: DataFrame, keys, digits: int = 2, min_support: int = 0) -> DataFrame:
    """Metrics per key combination; null below `min_support` rows. Null keys are left out."""
    for key in keys:
        eval_df = eval_df.where(F.col(key).isNotNull())
    counts = eval_df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[c.alias(n) for n, c in _confusion().items()]
    )
    shown = [F.when(F.col("n") >= min_support, F.col(m)).alias(m) for m in METRICS]
    return with_metrics(counts, digits).select(*keys, "n", *shown)


def metric_matrix(metrics: DataFrame, index: str, models) -> DataFrame:
    """One row per index value and a `mean` row; a column "{model} {metric}" per model and metric.

    The mean row averages the shown values of each column, nulls skipped. Both levels come from
    one rollup over the metric rows.
    """
    columns = [
        F.avg(F.when(F.col("model") == model, F.col(metric))).alias(f"{model} {metric}")
        for metric in METRICS
        for model in models
    ]
    label = F.when(F.grouping(index) == 1, "mean").otherwise(F.col(index))
    table = metrics.rollup(index).agg(label.alias("_label"), *columns)
    return table.drop(index).withColumnRenamed("_label", index)
