"""The first rows of every group against sorting."""

import random

import pytest
from pyspark.sql import functions as F

from goldquarry.operators import sampling
from goldquarry.operators.bottom import bottom_n


@pytest.mark.parametrize("parts,n", [(1, 3), (40, 3), (7, 100), (5, 0), (3, 10**6)])
def test_first_rows_of_each_group(spark, parts, n):
    rng = random.Random(n)
    rows = [(rng.choice(["a", "a", "b", None]), rng.random() < 0.5, f"{rng.randrange(10**4):05d}", rng.randrange(50)) for _ in range(3000)]
    rows += rows[:500]
    df = spark.createDataFrame(rows, "g string, side boolean, k string, i int").repartition(parts)
    want = []
    for key in {r[:2] for r in rows}:
        want += sorted((r for r in rows if r[:2] == key), key=lambda r: r[2:])[:n]
    got = [tuple(r) for r in bottom_n(df, ["g", "side"], ["k", "i"], n).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert bottom_n(df.where("false"), ["g"], ["k"], 5).collect() == []


def test_a_hot_slice_and_many_samples(spark, monkeypatch):
    """5,000 samples of each class where one slice holds a third of the rows: as if all rows were sorted."""
    df = spark.range(60_000, numPartitions=6).select(
        F.col("id").cast("string").alias("image_id"), (F.col("id") % 2 == 0).alias("drone_present")
    )
    hot = F.when(F.col("image_id").cast("int") % 3 == 0, F.lit("777")).otherwise(F.substring(F.md5("image_id"), 1, 3))
    key = F.concat(hot, F.md5("image_id"))
    monkeypatch.setattr(sampling, "sample_key", lambda seed, column: key)
    templates = [("q", "text", {"drone_present": True})]
    got = sampling.build_query_set(df, templates, 1, 5000)
    start = sampling._start(42, "q")
    data = [(r.image_id, r.drone_present, r.key) for r in df.withColumn("key", key).collect()]
    for side in (True, False):
        members = sorted((x for x in data if x[1] is side), key=lambda x: (x[2][:3] < start, x[2]))[:5000]
        assert {r.image_id for r in got.where(F.col("is_positive") == side).collect()} == {x[0] for x in members}


def test_no_window_over_rows(spark):
    df = spark.createDataFrame([("a", True)], "image_id string, drone_present boolean")
    plan = sampling.build_query_set(df)
    text = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert text.count("MapInArrow") >= 3 and "row_number" not in text
