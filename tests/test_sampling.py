"""Samples and query sets."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from goldquarry.operators import sampling


def people(spark, pos, neg, unknown=0):
    n = pos + neg + unknown
    return spark.range(n, numPartitions=3).select(
        F.col("id").cast("string").alias("image_id"),
        F.when(F.col("id") < pos, True).when(F.col("id") < pos + neg, False).alias("drone_present"),
    )


def sizes(df):
    got = {r[0]: r[1] for r in df.groupBy("drone_present").count().collect()}
    return got.get(True, 0), got.get(False, 0), got.get(None, 0)


def plain_quota(pos, neg, unknown, cap):
    """The rule in words: half each, odd row to the positives, shortfalls filled by the other side."""
    if cap == 0 or cap >= pos + neg + unknown:
        return pos, neg, unknown
    want_pos = cap - cap // 2
    take_pos = min(pos, max(want_pos, cap - neg))
    return take_pos, min(neg, cap - take_pos), 0


@pytest.mark.parametrize(
    "pos, neg, unknown, cap",
    [(6, 9, 0, 5), (6, 9, 0, 14), (2, 9, 0, 7), (9, 2, 0, 8), (0, 9, 3, 4), (9, 0, 0, 4), (5, 5, 5, 12),
     (5, 5, 5, 15), (5, 5, 5, 0), (5, 5, 0, 1), (0, 0, 4, 2)],
)
def test_balanced_sizes(spark, pos, neg, unknown, cap):
    got = sampling.balanced_sample(people(spark, pos, neg, unknown), "drone_present", cap)
    assert sizes(got) == plain_quota(pos, neg, unknown, cap)


@pytest.mark.parametrize("cap", [999, 1000, 1001, 1500, 2400])
def test_samples_are_the_lowest_keys_of_each_class(spark, cap):
    from hashlib import md5

    df = people(spark, 1300, 900, 500)
    key = lambda r: md5(f"42|{r[0]}".encode()).hexdigest()
    pos, neg, _ = plain_quota(1300, 900, 500, cap)
    want = []
    for cls, quota in ((True, pos), (False, neg)):
        want += sorted((tuple(r) for r in df.collect() if r[1] is cls), key=key)[:quota]
    assert rows(sampling.balanced_sample(df, "drone_present", cap)) == sorted(want, key=repr)


def test_query_set_is_the_first_keys_from_the_start_on(spark):
    from hashlib import md5

    df = items(spark, 3000)
    hexed = lambda *parts: md5("|".join(parts).encode()).hexdigest()
    chosen = rows(sampling.build_query_set(df, n_queries=2, n_samples=37), "query_id", "is_positive", "image_id")
    tests = {
        "q_drone_present": lambda r: r.drone_present is True,
        "q_dark_lighting": lambda r: r.drone_present is True and r.lighting == "dark",
    }
    want, data = [], df.collect()
    for query_id, positive in tests.items():
        start = hexed("42", query_id)[:3]
        order = lambda r: (hexed("42", r.image_id) < start, hexed("42", r.image_id))
        for cls in (True, False):
            members = sorted((r for r in data if positive(r) is cls), key=order)[:37]
            want += [(query_id, cls, r.image_id) for r in members]
    assert chosen == sorted(want, key=repr)


def test_copies_of_an_id_keep_the_sample_size(spark):
    df = spark.range(60).select(
        F.when(F.col("id") < 50, "same").otherwise(F.col("id").cast("string")).alias("image_id"),
        (F.col("id") % 2 == 0).alias("drone_present"),
    )
    for n in (3, 20):
        counts = sampling.build_query_set(df, n_queries=1, n_samples=n).groupBy("is_positive").count()
        assert rows(counts) == [(False, n), (True, n)]
    assert sampling.balanced_sample(df, "drone_present", 31).count() == 31


def items(spark, n=200):
    word = lambda *w: F.get(F.array(*map(F.lit, w)), F.pmod(F.xxhash64("id"), F.lit(len(w))).cast("int"))
    return spark.range(n).select(
        F.col("id").cast("string").alias("image_id"),
        F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 2 == 1).alias("drone_present"),
        word("dark", "bright", "normal").alias("lighting"),
        word("sky", "building").alias("background"),
    )


def test_absent_columns_skip_templates(spark):
    found = [r.query_id for r in sampling.template_eligibility(items(spark)).orderBy("position").collect()]
    assert found == ["q_drone_present", "q_dark_lighting", "q_sky_background", "q_building_background",
                     "q_no_drone", "q_dark_sky", "q_bright_lighting"]


def test_query_set_sizes_and_classes(spark):
    df = items(spark)
    chosen = sampling.build_query_set(df, n_queries=3, n_samples=4)
    counts = {(r.query_id, r.is_positive): r["count"] for r in chosen.groupBy("query_id", "is_positive").count().collect()}
    assert counts == {(q, c): 4 for q in ("q_drone_present", "q_dark_lighting", "q_sky_background") for c in (True, False)}
    joined = chosen.join(df, "image_id").where("query_id = 'q_drone_present'")
    assert joined.where("is_positive").where("drone_present is not true").count() == 0
    assert joined.where("not is_positive").where("drone_present is true").count() == 0
    assert chosen.groupBy("query_id", "image_id").count().where("count > 1").count() == 0


def test_null_rows_can_be_negatives(spark):
    df = spark.createDataFrame([(str(i), None if i else True) for i in range(6)], "image_id string, drone_present boolean")
    got = rows(sampling.build_query_set(df, n_queries=1, n_samples=1), "query_id", "is_positive")
    assert got == [("q_drone_present", False), ("q_drone_present", True)]


def test_n_samples_edge(spark):
    df = people(spark, 5, 4)
    picked = lambda n: {r.query_id for r in sampling.build_query_set(df, n_samples=n).collect()}
    assert picked(4) == {"q_drone_present", "q_no_drone"} and picked(5) == set()
    assert sampling.build_query_set(df, n_queries=0).count() == 0
    assert sampling.build_query_set(df.drop("drone_present")).count() == 0


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_samples_do_not_depend_on_partitioning(spark, partitions):
    df = items(spark)
    want = rows(sampling.build_query_set(df)), rows(sampling.balanced_sample(df, "drone_present", 21))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        moved = df.repartition(int(partitions) + 2)
        got = rows(sampling.build_query_set(moved)), rows(sampling.balanced_sample(moved, "drone_present", 21))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == want


def test_rows_outside_reached_slices_are_dropped_before_the_shuffle(spark, tmp_path):
    items(spark).write.parquet(str(tmp_path / "items"))
    df = sampling.build_query_set(spark.read.parquet(str(tmp_path / "items")))
    df.collect()
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    final = text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
    # The counting pass runs once: its exchange is reused for eligibility and slices.
    assert "ReusedExchange" in final or "ReusedStage" in final
    assert "BroadcastHashJoin [_slice" in final


def test_nested_form(spark):
    chosen = spark.createDataFrame(
        [("q", "t", "b", True), ("q", "t", "a", True), ("q", "t", "c", False)],
        "query_id string, query_text string, image_id string, is_positive boolean",
    )
    row = sampling.query_set_nested(chosen).first()
    assert (row.positive_ids, row.negative_ids, row.all_ids) == (["a", "b"], ["c"], ["a", "b", "c"])
    plan = sampling.eval_plan(chosen, ["m1", "m2"]).first()
    assert tuple(plan) == (2, 1, 3, 6)
