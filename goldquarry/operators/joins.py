"""Joins: keyed attachment, cache split, path resolution and reference checks.

Broadcast hints are only given to sides whose row count has a proven bound (`small_side`);
all other joins are left to the optimizer, which checks sizes itself. Keys that hold a large
share of the rows are salted (`salted_join`).
"""

from pyspark.sql import Column, DataFrame, functions as F

from goldquarry.operators.membership import possible_matches

# Rows up to which a side with a proven bound may be broadcast.
BROADCAST_ROWS = 200_000

# A key with at least this share of the rows counts as hot; there are at most 1 / share of them.
HOT_SHARE = 0.005
SALTS = 32


def small_side(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Hint a broadcast if at most `max_rows` rows are possible and that is few; else no hint."""
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """Keys that may hold at least `share` of the rows: no such key is missed, some may be extra.

    One bounded sketch per task is merged, so neither the keys nor the rows are shuffled,
    and the result has at most 1 / share rows.
    """
    sketch = df.select(F.col(key)).where(F.col(key).isNotNull()).freqItems([key], share)
    return sketch.select(F.explode(f"{key}_freqItems").alias(key))


def salted_join(
    left: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    spread: Column | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join on `key`, with the rows of hot left keys spread over `salts` tasks.

    Only lookup rows of hot keys are replicated. `spread` is any column that varies among
    rows with the same key; by default a hash of the left side's scalar columns.
    Works for left, inner, left_semi and left_anti joins.
    """
    if spread is None:
        scalars = [
            f.name
            for f in left.schema.fields
            if f.dataType.typeName() not in ("binary", "array", "struct", "map", "variant")
        ]
        spread = F.xxhash64(*scalars)
    hot = F.broadcast(hot_keys(left, key).distinct().withColumn("_hot", F.lit(True)))
    # Null keys match nothing, so their rows may go anywhere.
    salt = F.when(F.col("_hot") | F.col(key).isNull(), F.pmod(spread, F.lit(salts)).cast("int")).otherwise(F.lit(0))
    all_salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_left = left.join(hot, key, "left").withColumn("_salt", salt).drop("_hot")
    salted_lookup = (
        lookup.join(hot, key, "left").withColumn("_salt", F.explode(all_salts)).drop("_hot")
    )
    return salted_left.join(salted_lookup, [key, "_salt"], how).drop("_salt")


def unique_rows(df: DataFrame, key: str, last_by: str | None = None) -> DataFrame:
    """One row per key: the last by `last_by`, or an error at run time if a key repeats.

    The grouping uses the same partitioning as a join on the key that follows it, so it adds
    no shuffle, and copies of a key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    if last_by is not None:
        row = F.max_by(F.struct(*rest), F.struct(last_by, *_sortable(df, rest)))
        return df.groupBy(key).agg(row.alias("_row")).select(key, "_row.*")
    # first() of every column comes from the same row.
    kept = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    repeated = F.raise_error(F.concat(F.lit(f"duplicate {key}: "), F.col(key).cast("string")))
    return kept.select(key, *[F.when(F.col("_n") == 1, F.col(c)).otherwise(repeated).alias(c) for c in rest])


def _sortable(df: DataFrame, names) -> list[str]:
    kinds = {f.name: f.dataType.typeName() for f in df.schema.fields}
    return [n for n in names if kinds[n] not in ("map", "variant")]


def attach(
    df: DataFrame, other: DataFrame, key: str, salted: bool = False, last_by: str | None = None
) -> DataFrame:
    """Left join of per-item columns by key; repeated keys in `other` never fan rows out."""
    lookup = unique_rows(other, key, last_by)
    return salted_join(df, lookup, key) if salted else df.join(lookup, key, "left")


def with_cached(requests: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Requests with the cached columns and whether there is a cached row (`hit`).

    Requests for copies of the same content share a key, so hot keys are salted.
    """
    known = unique_rows(cache, key, last_by=key).withColumn("hit", F.lit(True))
    return salted_join(requests, known, key).withColumn("hit", F.coalesce("hit", F.lit(False)))


def split_cached(
    requests: DataFrame, cache: DataFrame, key: str, refresh: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(requests with the cached columns, requests still to be answered).

    With `refresh` nothing counts as cached.
    """
    if refresh:
        return with_cached(requests, cache.where(F.lit(False)), key).where("hit").drop("hit"), requests
    hits = with_cached(requests, cache, key).where("hit").drop("hit")
    return hits, salted_join(requests, cache.select(key).distinct(), key, "left_anti")


def with_file_exists(df: DataFrame, listing: DataFrame, path_col: str = "image_path") -> DataFrame:
    """Flag rows whose file is in a listing, by one join instead of one file call per row.

    Files of the listing that no row can mean are left out before anything moves, and rows without a path are
    spread over all tasks.
    """
    known = possible_matches(listing.select(path_col), df, path_col).distinct()
    known = known.select(F.col(path_col).alias("_path"), F.lit(True).alias("_listed"))
    # A null path stands for no file, so its rows may go anywhere: no path begins with a zero character.
    scalars = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("binary", "array", "struct", "map", "variant")]
    anywhere = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*scalars, F.monotonically_increasing_id()), F.lit(64 * SALTS)))
    return (
        df.withColumn("_path", F.coalesce(F.col(path_col), anywhere))
        .join(known, "_path", "left")
        .withColumn("file_exists", F.coalesce("_listed", F.lit(False)))
        .select(*df.columns, "file_exists")
    )


def resolve_path(
    ids: DataFrame,
    datasets: list[DataFrame],
    files: DataFrame | None = None,
    key: str = "image_id",
    path_col: str = "image_path",
) -> DataFrame:
    """Path per id from the first dataset, in order, whose first row for it has an existing file.

    The first row of an id within a dataset is the one with the smallest path, nulls first.
    """
    wanted = ids.select(key).distinct()
    found = None
    for priority, df in enumerate(datasets):
        first = (
            df.select(key, path_col)
            .join(wanted, key, "left_semi")
            .groupBy(key)
            .agg(F.min_by(path_col, F.struct(F.col(path_col).isNotNull(), path_col)).alias(path_col))
            .withColumn("_priority", F.lit(priority))
        )
        found = first if found is None else found.unionByName(first)
    found = found.where(F.col(path_col) != "")
    if files is not None:
        # Files that no candidate can mean don't move.
        listed = possible_matches(files.select(path_col), found, path_col)
        found = found.join(listed.distinct(), path_col, "left_semi")
    best = found.groupBy(key).agg(F.min_by(path_col, "_priority").alias(path_col))
    return wanted.join(best, key, "left")


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def check_refs(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Keys of `df` without a row in `other`."""
    return df.select(key).distinct().join(other.select(key).distinct(), key, "left_anti")
