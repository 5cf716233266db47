import math

import numpy as np
import pytest

from goldquarry.llm import negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, vector array<double>, label int"


def brute(rows, n_positives=5, n_negatives=10, anchor=lambda i: i % 10 == 0):
    good = {}
    for key, vector, label in rows:
        if key is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        found = (label, [math.floor(256 * x) for x in vector])
        good[key] = min(good.get(key, found), found)
    out = []
    for a, (label, components) in good.items():
        if not anchor(a):
            continue
        score = {k: sum(x * y for x, y in zip(components, v)) for k, (_, v) in good.items() if k != a and len(v) == len(components)}
        best = sorted((k for k in score if good[k][0] == label), key=lambda k: (-score[k], k))[:n_positives]
        for p in best:
            band = [k for k in score if good[k][0] != label and 30 * score[p] <= 100 * score[k] <= 90 * score[p]]
            for rank, k in enumerate(sorted(band, key=lambda k: (-score[k], k))[:n_negatives], 1):
                out.append((a, p, rank, k, score[p], score[k]))
    return sorted(out)


def mined(spark, rows, parts=3, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({"rank": F.lit(1), "id": F.lit("x"), "task": F.lit(0)})
    return sorted(map(tuple, negatives.mine_negatives(df, F.col("vec_id") % 10 == 0, vector="vector", **more).collect()))


@pytest.mark.parametrize("seed", range(4))
def test_scores_are_inner_products(seed):
    rng = np.random.default_rng(seed)
    dims, most = int(rng.integers(1, 30)), int(10 ** rng.integers(1, 8))
    rows, anchors = rng.integers(-most, most + 1, (50, dims)), rng.integers(-most, most + 1, (7, dims))
    bits = negatives.bit_planes(rows)
    got = negatives.scores(negatives._small_sums(negatives.subset_sums(anchors), len(bits)), bits)
    assert (got == rows @ anchors.T).all()


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, monkeypatch, seed):
    """Many tasks, slices and blocks; ties, repeated rows, one label for a third of the rows."""
    monkeypatch.setattr(negatives, "LEAST_TASK_ROWS", 40)
    monkeypatch.setattr(negatives, "TASK_ROWS", 60)
    monkeypatch.setattr(negatives, "TASK_ANCHORS", 16)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 17)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 5)
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(400):
        vector = [float(x) for x in np.round(rng.standard_normal(10), 1 + seed)]
        rows.append((i, vector, 0 if i % 3 == 0 else int(rng.integers(0, 4))))
    rows += [(400 + i, rows[i % 7][1], rows[i % 7][2]) for i in range(60)]  # ties
    rows += rows[:30]  # repeated rows
    rows += [(5, [0.5] * 10, 9), (None, [1.0] * 10, 1), (700, None, 1), (710, [1.0] * 10, None)]
    rows += [(720, [None] + [1.0] * 9, 1), (730, [float("nan")] * 10, 1), (740, [float("inf")] + [0.0] * 9, 1)]
    rows += [(750, [0.1, 0.2], 1), (760, [0.1, 0.3], 1), (761, [0.1, 0.1], 2), (770, [], 1), (780, [0.0] * 10, 1)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, rows, parts=7, positives=2, negatives=3) == brute(rows, 2, 3)


def test_no_rows_no_anchors_no_negatives(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []
    assert mined(spark, [(10, [1.0], 1), (20, [0.5], 1)]) == []
    assert mined(spark, [(10, [1.0], 1), (20, [0.5], 1), (3, [0.3], 2)]) == brute([(10, [1.0], 1), (20, [0.5], 1), (3, [0.3], 2)])
