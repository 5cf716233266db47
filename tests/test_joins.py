"""Keyed joins: duplicates, hot keys and path resolution."""

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from goldquarry.operators import joins
from goldquarry.operators.membership import key_bitmaps, possible_matches


def skewed(spark, n=3000):
    """A third of the rows share one key, the rest have their own; one key is null."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") > 1, F.concat(F.lit("k"), "id")).alias("key"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = skewed(spark)
    lookup = left.where((F.col("id") % 2 == 0) & F.col("key").isNotNull()).groupBy("key").agg(F.min("id").alias("v"))
    assert rows(joins.salted_join(left, lookup, "key", how)) == rows(left.join(lookup, "key", how))


def test_salted_join_spreads_the_hot_key(spark):
    left = skewed(spark, 30_000)
    lookup = left.where(F.col("key").isNotNull()).groupBy("key").agg(F.min("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        parts = (
            joins.salted_join(left, lookup, "key").where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(parts) >= 6 and sum(r["count"] for r in parts) == 10_000
    assert max(r["count"] for r in parts) < 5_000


def test_hot_keys_are_found_and_bounded(spark):
    found = [r[0] for r in joins.hot_keys(skewed(spark, 30_000), "key", 0.01).collect()]
    assert "hot" in found and len(found) <= 100


def test_hot_keys_of_nothing(spark):
    empty = spark.createDataFrame([], "id bigint, key string")
    assert joins.hot_keys(empty, "key").collect() == []
    assert joins.salted_join(empty, empty.select("key"), "key").collect() == []


def test_attach_refuses_repeated_keys(spark):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    once = spark.createDataFrame([("a", 1)], "k string, v int")
    assert rows(joins.attach(left, once, "k")) == [("a", 1), ("b", None)]
    assert rows(joins.attach(left, once, "k", salted=True)) == [("a", 1), ("b", None)]
    twice = once.union(spark.createDataFrame([("a", 2)], "k string, v int"))
    with pytest.raises(PySparkException, match="duplicate k: a"):
        joins.attach(left, twice, "k").collect()
    assert rows(joins.attach(left, twice, "k", last_by="v")) == [("a", 2), ("b", None)]


def test_split_cached(spark):
    requests = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "key string, n int")
    cache = spark.createDataFrame([("a", "x"), ("a", "x"), ("c", "y")], "key string, v string")
    hits, misses = joins.split_cached(requests, cache, "key")
    assert rows(hits, "n", "v") == [(1, "x"), (2, "x")] and rows(misses, "n") == [(3,)]
    hits, misses = joins.split_cached(requests, cache, "key", refresh=True)
    assert hits.count() == 0 and misses.count() == 3


def test_resolve_path_goes_to_the_next_dataset(spark):
    table = lambda *r: spark.createDataFrame(list(r), "image_id string, image_path string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",)], "image_id string")
    first = table(("a", "/1/a"), ("a", "/1/z"), ("b", "/1/gone"), ("c", None), ("c", "/1/c"), ("d", ""))
    second = table(("a", "/2/a"), ("b", "/2/b"), ("c", "/2/c"))
    files = table(*[("", p) for p in ("/1/a", "/1/z", "/1/c", "/2/a", "/2/b", "/2/c")])
    got = rows(joins.resolve_path(ids, [first, second], files))
    assert got == [("a", "/1/a"), ("b", "/2/b"), ("c", "/2/c"), ("d", None)]


def test_checks(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(joins.check_unique(df, "k")) == [("a", 2)]
    other = spark.createDataFrame([("b",)], "k string")
    assert rows(joins.check_refs(df.where("k is not null"), other, "k")) == [("a",)]


def test_small_side_only_hints_within_the_bound(spark):
    df = spark.range(1)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(joins.small_side(df, 10))
    assert not hinted(joins.small_side(df, None))
    assert not hinted(joins.small_side(df, joins.BROADCAST_ROWS + 1))


def test_file_exists_spreads_null_paths_and_leaves_listings_in_place(spark):
    df = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("/f/"), F.col("id") % 500)).alias("image_path")
    )
    listing = spark.range(100_000).select(F.concat(F.lit("/f/"), F.col("id") * 2).alias("image_path"))
    got = joins.with_file_exists(df, listing)
    assert got.columns == ["id", "image_path", "file_exists"]
    want = {(r.id, r.image_path, r.image_path is not None and int(r.image_path[3:]) % 2 == 0) for r in df.collect()}
    assert {tuple(r) for r in got.collect()} == want and got.count() == 30_000
    moved = possible_matches(listing, df, "image_path")
    assert 200 <= moved.count() <= 1000  # 250 paths are in both
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        placed = joins.with_file_exists(df, listing).withColumn("part", F.spark_partition_id())
        parts = placed.where("image_path IS NULL AND NOT file_exists").groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(parts) >= 6 and max(r["count"] for r in parts) < 3500


def test_possible_matches_misses_none(spark):
    small = spark.range(50_000).select(F.concat(F.lit("k"), F.col("id") * 7).alias("k")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    large = spark.range(400_000).select(F.concat(F.lit("k"), "id").alias("k"), "id")
    kept = possible_matches(large, small, "k")
    assert kept.columns == ["k", "id"]
    assert kept.where("id % 7 = 0 AND id < 350000").count() == 50_000 and kept.count() < 60_000
    assert possible_matches(large, small.where("false"), "k").count() == 0
    assert key_bitmaps(small, "k").count() <= 1024
