"""Filters, statistics and histograms against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from helpers import rows
from pyspark.sql import functions as F

from goldquarry.operators import quality


@pytest.fixture(scope="module")
def stats(spark):
    data = [("a", 19.9, 100.0, "eye_level"), ("b", 20.0, 235.0, None), ("c", None, None, "top_down"),
            ("d", None, None, "unknown"), ("e", 50.0, 24.0, "eye_level"), ("f", float("nan"), 25.0, "eye_level")]
    return spark.createDataFrame(data, "image_id string, blur_score double, brightness double, camera_angle string")


def test_quality_filter(stats):
    assert rows(quality.quality_filter(stats), "image_id") == [("b",), ("d",), ("f",)]
    off = quality.quality_filter(stats, ranges={"blur_score": (None, None)}, exclude={})
    assert off.count() == 6


def test_kept_and_dropped_add_up(stats):
    row = quality.kept_dropped(stats, quality.quality_predicate(stats.columns)).first()
    assert tuple(row) == (3, 3, 6)
    unknown = quality.kept_dropped(stats, F.col("brightness") > 50).first()
    assert unknown.kept + unknown.dropped == unknown.total


def test_facet_filter(spark):
    df = spark.createDataFrame([(True, "sky", 1), (False, None, 2), (None, "sky", 3)], "drone_present boolean, background string, n int")
    pick = lambda **c: [r[0] for r in rows(quality.facet_filter(df, c), "n")]
    assert pick(drone_present="True") == [1] and pick(drone_present="None") == [3]
    assert pick(background="sky", n=3) == [3]
    assert pick(background="All", drone_present=None, missing="x") == [1, 2, 3]


def test_first_n_is_ordered(spark):
    df = spark.createDataFrame([("c",), ("a",), ("b",)], "image_id string")
    assert [r[0] for r in quality.first_n(df, 2).collect()] == ["a", "b"]
    assert quality.first_n(df, 0).count() == 3


def test_caps_take_the_same_rows_however_they_lie(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "k0700").when(F.col("id") > 4, F.format_string("k%04d", "id")).alias("image_id")
    )
    keys = sorted((r[0] for r in df.collect()), key=lambda k: k or "")
    for n in (11, 600, 1000, 1700, 2990, 3000, 4000):
        got = sorted((r[0] for r in quality.first_n(df, n).collect()), key=lambda k: k or "")
        assert got == keys[:n], n
    # Rows that share a key: the same ones from any partitioning, and fewer are part of more.
    tagged = df.withColumn("tag", F.monotonically_increasing_id() % 7).withColumn("id", F.lit(1))
    pick = lambda table, n: [tuple(r) for r in quality.first_n(table, n).collect()]
    assert pick(tagged, 500) == pick(tagged.repartition(5), 500) == pick(tagged, 900)[:500]


COLUMNS = {
    "normal": lambda rng, n: rng.normal(5, 3, n),
    "hot": lambda rng, n: np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 20),
    "few": lambda rng, n: rng.integers(0, 3, n).astype(float),
    "heavy": lambda rng, n: rng.pareto(0.5, n),
    "constant": lambda rng, n: np.full(n, 2.5),
}


@pytest.mark.parametrize("n", [1, 2, 5, 4000])
def test_describe_equals_pandas(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({k: make(rng, n) for k, make in COLUMNS.items()})
    if n > 2:
        pdf.loc[pdf.index[:2], "normal"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5)
    got = {r.stat: r for r in quality.describe(df, list(COLUMNS)).collect()}
    want = pdf.describe()
    for name in COLUMNS:
        r, w = got[name], want[name]
        assert r["count"] == w["count"]
        for ours, theirs in [("mean", "mean"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert r[ours] == pytest.approx(w[theirs], abs=5.1e-4, rel=1e-9), (name, ours)
        if n > 1:
            assert r["std"] == pytest.approx(w["std"], abs=5.1e-4, rel=1e-9)


def test_quantiles_are_exact_whatever_the_cuts(spark):
    rng = np.random.default_rng(1)
    data = np.concatenate([rng.normal(0, 1, 3000), np.full(2000, 0.25), rng.pareto(1, 500) * 1e6])
    df = spark.createDataFrame(pd.DataFrame({"v": data})).repartition(7)
    probabilities = [0.0, 0.1, 0.333, 0.5, 0.9, 0.999, 1.0]
    for margin in (0.002, 0.0, 0.2):
        got = {r.q: r.value for r in quality.quantiles(df, ["v"], probabilities, margin).collect()}
        for p in probabilities:
            assert got[p] == pytest.approx(np.quantile(data, p), rel=1e-12)


def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 500), "b": np.full(500, 3.0)})
    pdf.loc[:9, "a"] = np.nan
    df = spark.createDataFrame(pdf)
    table = quality.histogram(df, ["a", "b"]).orderBy("stat", "bin").collect()
    for name in pdf:
        counts, edges = np.histogram(pdf[name].dropna(), bins=30)
        mine = [r for r in table if r.stat == name]
        assert [r["count"] for r in mine] == list(counts)
        assert [r.low for r in mine] == pytest.approx(list(edges[:-1]))
        assert mine[-1].high == pytest.approx(edges[-1])


def test_statistics_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert [tuple(r) for r in quality.describe(df, ["v"]).collect()] == [("v", 0, *[None] * 7)]
    assert quality.histogram(df, ["v"]).collect() == []


def test_quantiles_of_many_distinct_values_take_rounds(spark, monkeypatch):
    """20 million different doubles, a third of them in a narrow band, ordered a few thousand at a time."""
    monkeypatch.setattr(quality, "SLICE_ROWS", 3000)
    n = 20_000_000
    mixed = F.pmod(F.col("id") * 7_919_993 + 17, F.lit(n)).cast("double")
    df = spark.range(n, numPartitions=8).select(F.when(mixed % 3 == 0, mixed * 1e-9).otherwise(mixed).alias("v"))
    values = np.arange(n, dtype=float)
    values = np.where(values % 3 == 0, values * 1e-9, values)
    seen = []
    ordered = quality._values_at

    def counted(numbers, places, wanted):
        near = [p.isNotNull() for p in places.values()]
        seen.append(numbers.where(near[0]).count())
        return ordered(numbers, places, wanted)

    monkeypatch.setattr(quality, "_values_at", counted)
    probabilities = [0.0, 0.25, 1 / 3, 0.5, 0.87654321, 1.0]
    got = {r.q: r.value for r in quality.quantiles(df, ["v"], probabilities).collect()}
    for p in probabilities:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-14)
    assert seen and seen[0] <= 3000 * 2 * len(probabilities)
