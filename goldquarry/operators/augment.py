"""Augmentation candidates with lineage, and the extended evaluation set."""

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from goldquarry import fixed_values as fv
from goldquarry.functions.labels import recode
from goldquarry.functions.text import cache_key, content_b64
from goldquarry.operators.batches import bisected
from goldquarry.operators.joins import salted_join, small_side
from goldquarry.operators.quality import first_n


def positives(df: DataFrame) -> DataFrame:
    return df.where(F.col("drone_present"))


def blur_candidates(df: DataFrame, out_dir: str, max_rows: int = 0) -> DataFrame:
    """One blurred variant row per source row (the first `max_rows` by id; 0 means all).

    Everything not named here, statistics included, is inherited from the source. The pictures
    come from `operators.pixels.blurred_files`; `with_pictures` tells which rows have one.
    """
    source = F.col("image_id")
    return first_n(df, max_rows).withColumns(
        {
            "image_id": F.concat(source, F.lit(fv.BLUR_ID_SUFFIX)),
            "image_path": F.concat(F.lit(out_dir.rstrip("/") + "/"), source, F.lit(fv.BLUR_ID_SUFFIX + ".jpg")),
            "augmentation_type": F.lit(fv.BLUR_TYPE),
            "source_image_id": source,
            "is_synthetic": F.lit(True),
        }
    )


def with_pictures(candidates: DataFrame, pictures: DataFrame) -> DataFrame:
    """Candidates that are synthetic exactly if `pictures` (image_path) holds their picture."""
    known = pictures.select("image_path").distinct().withColumn("_made", F.lit(True))
    made = F.coalesce("_made", F.lit(False))
    return candidates.join(known, "image_path", "left").withColumn("is_synthetic", made).select(*candidates.columns)


def variant_requests(df: DataFrame, prompts=None, max_rows: int = 0) -> DataFrame:
    """Every source row once per prompt, with the request's `label` and `prompt`."""
    prompts = fv.VARIANT_PROMPTS if prompts is None else prompts
    pairs = [F.struct(F.lit(k).alias("label"), F.lit(p).alias("prompt")) for k, p in prompts.items()]
    return first_n(df, max_rows).select("*", F.explode(F.array(*pairs)).alias("_p")).select(
        *df.columns, "_p.label", "_p.prompt"
    )


def edit_outcomes(
    requests: DataFrame,
    editor: Callable,
    cache: DataFrame | None = None,
    content_of: DataFrame | None = None,
    parallelism: int | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda new: new,
) -> tuple[DataFrame, DataFrame]:
    """(outcome per request key, new outcomes) for requests (key, image_id, image_path, prompt).

    Each key is edited once, however many copies of the same content there are. `editor` gets
    a batch of requests and returns one status per row, "ok" or "failed: reason"; it stores the
    edited images itself. With `content_of` (image_path, content) it also sees the content,
    which is joined last, for the images with open requests only and once for all their prompts.
    """
    open_requests = requests.groupBy("key").agg(
        F.min(F.struct("image_id", "image_path", "prompt")).alias("r")
    ).select("key", "r.*")
    if cache is not None:
        # Failed edits are tried again. Keys are distinct on both sides, so no key is hot.
        cache = cache.where(F.col("status") == "ok").select("key", "status").distinct()
        open_requests = open_requests.join(cache.select("key"), "key", "left_anti")
    if content_of is not None:
        # At most one request per prompt in a row.
        asked = F.collect_list(F.struct("key", "image_id", "prompt")).alias("asked")
        open_requests = open_requests.groupBy("image_path").agg(asked).join(content_of, "image_path", "left")

    content_of_given = content_of is not None

    def run(batches):
        for batch in batches:
            if content_of_given:
                batch = batch.explode("asked", ignore_index=True)
                batch = pd.concat([batch.drop(columns="asked"), pd.DataFrame(list(batch["asked"]))], axis=1)
            yield pd.DataFrame({"key": batch["key"], "status": _statuses(editor, batch)})

    if parallelism:
        open_requests = open_requests.repartition(parallelism)
    new = store(open_requests.mapInPandas(run, "key string, status string"))
    return new if cache is None else new.unionByName(cache), new


def _statuses(editor: Callable, batch: pd.DataFrame) -> list:
    """Statuses of a batch; failing rows are found by halving."""
    return [status if error is None else f"failed: {error}" for status, error in bisected(editor, batch)]


def variant_candidates(
    df: DataFrame,
    editor: Callable,
    out_dir: str,
    prompts=None,
    cache: DataFrame | None = None,
    contents: DataFrame | None = None,
    max_rows: int = 0,
    parallelism: int | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda new: new,
    keep: Callable[[DataFrame], None] = lambda new: None,
) -> DataFrame:
    """One prompted variant row per source row and prompt, failed ones included.

    `contents` (image_path, content) gives the bytes the cache key is made of; without it the
    path stands for the content. Contents are read where they lie: only digests, one per
    prompt, move. `store` writes a table and returns the written one; it is applied to the
    digests and to the new outcomes, so that neither is computed twice. `keep` gets the stored new
    outcomes (key, status), for the `cache` of the next run. A candidate is synthetic exactly if its edit succeeded.
    """
    prompts = fv.VARIANT_PROMPTS if prompts is None else prompts
    requests = variant_requests(df, prompts, max_rows)
    if contents is None:
        keyed = requests.withColumn("key", cache_key(F.col("image_path"), F.col("prompt")))
    else:
        read = contents
        if max_rows:
            paths = small_side(first_n(df, max_rows).select("image_path"), max_rows)
            read = contents.join(paths, "image_path", "left_semi")
        b64 = content_b64(F.col("content"))
        keys = [
            F.struct(F.lit(p).alias("prompt"), cache_key(b64, F.lit(p)).alias("key"))
            for p in prompts.values()
        ]
        # The keys of a content are projected together, so it is encoded once, and then unnested.
        digests = read.select("image_path", F.array(*keys).alias("k")).select(
            "image_path", F.inline("k")
        )
        digests = store(digests)
        keyed = requests.join(digests, ["image_path", "prompt"], "left")
    outcomes, new = edit_outcomes(
        keyed.where(F.col("key").isNotNull()).select("key", "image_id", "image_path", "prompt"),
        editor,
        cache,
        contents,
        parallelism,
        store,
    )
    keep(new)
    # Copies of one content share a key, so the join back spreads hot keys.
    joined = salted_join(keyed, outcomes, "key", spread=F.xxhash64("image_id"))
    status = F.coalesce("status", F.lit("failed: no content"))
    ok = status == "ok"
    source = F.col("image_id")
    out = F.concat(F.lit(out_dir.rstrip("/") + "/"), source, F.lit("__"), F.col("label"), F.lit(".jpg"))
    return joined.withColumns(
        {
            "image_id": F.concat(source, F.lit(fv.VARIANT_ID_INFIX), F.col("label")),
            "source_image_id": source,
            "image_path": F.when(ok, out),
            "augmentation_type": F.when(ok, fv.VARIANT_TYPE).otherwise(fv.VARIANT_FAILED_TYPE),
            "augment_label": F.col("label"),
            "is_synthetic": ok,
            "openai_augment_status": status,
        }
    ).drop("key", "status", "label", "prompt")


def patch_labels(df: DataFrame) -> DataFrame:
    """Adjust inherited labels to what the augmentation did to the picture."""
    label = F.col("augment_label") if "augment_label" in df.columns else F.lit(None).cast("string")
    blurred = (F.col("augmentation_type") == fv.BLUR_TYPE) | label.isin(fv.BLURRY_VARIANTS)
    return df.withColumns(
        {
            "lighting": recode(label, fv.LIGHTING_BY_VARIANT, F.col("lighting")),
            "blur_bucket": F.when(blurred, "blurry").otherwise(F.col("blur_bucket")),
        }
    )


def augment_success(candidates: DataFrame) -> DataFrame:
    """Succeeded and attempted variants per label, and in total (label "total")."""
    label = F.when(F.grouping("augment_label") == 1, "total").otherwise(F.col("augment_label"))
    table = (
        candidates.where(F.col("openai_augment_status").isNotNull())
        .rollup("augment_label")
        .agg(
            label.alias("label"),
            F.count_if(F.col("openai_augment_status") == "ok").alias("ok"),
            F.count(F.lit(1)).alias("attempted"),
        )
    )
    return table.select("label", "ok", "attempted")


def candidate_union(*tables: DataFrame) -> DataFrame:
    """All candidates; columns only some tables have are null elsewhere."""
    combined = tables[0]
    for table in tables[1:]:
        combined = combined.unionByName(table, allowMissingColumns=True)
    return combined


def extend_eval_set(golden: DataFrame, *candidates: DataFrame) -> DataFrame:
    """Golden rows and the candidates whose image exists."""
    made = candidate_union(*candidates).where(F.col("is_synthetic"))
    return golden.unionByName(made, allowMissingColumns=True)


def lineage(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """Source / variant pairs; the source path is null if the source row is gone."""
    label = F.col("augment_label") if "augment_label" in candidates.columns else F.lit(None).cast("string")
    status = (
        F.col("openai_augment_status")
        if "openai_augment_status" in candidates.columns
        else F.lit(None).cast("string")
    )
    variants = candidates.where(F.col("source_image_id").isNotNull()).select(
        "source_image_id",
        "image_id",
        F.col("image_path").alias("variant_path"),
        "augmentation_type",
        label.alias("augment_label"),
        status.alias("openai_augment_status"),
        "is_synthetic",
    )
    sources = items.groupBy(F.col("image_id").alias("source_image_id")).agg(
        F.min("image_path").alias("source_path")
    )
    return variants.join(sources, "source_image_id", "left")
