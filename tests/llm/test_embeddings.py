import brute
import numpy as np
import pytest

from goldquarry.llm import embeddings, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def result(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def clusters(rng, sizes, noise, dim=16):
    out = []
    for size in sizes:
        center = rng.standard_normal(dim)
        out += [center + noise * rng.standard_normal(dim) * np.linalg.norm(center) / dim**0.5 for _ in range(size)]
    return out


def test_whole_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert result(queries.op8_embedding_dedup(spark, sf_dir)) == brute.near_vectors(rows)


def test_recall_at_the_threshold_and_counts_of_large_groups(spark, monkeypatch):
    """Links spread around the threshold; one dense group of more vectors than a window or a block holds."""
    monkeypatch.setattr(embeddings, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(3)
    vectors = clusters(rng, [2] * 200 + [5] * 60, 0.26) + clusters(rng, [300], 0.05)
    rows = [(i, v.astype(np.float32).tolist(), i % 3 if i < 700 else 1) for i, v in enumerate(vectors)]
    rows = [(i, v, 0 if i < 700 else 1) for i, v, _ in rows]
    want = brute.near_vectors(rows)
    got = result(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    links = sum(n for n, _ in want.values())
    assert links > 300 * 299
    assert sum(n for n, _ in got.values()) >= 0.98 * links
    assert all(got[k][0] <= want[k][0] for k in want)
    dense = [k for k in want if k >= 700]
    assert [got[k] for k in dense] == [want[k] for k in dense]


def test_copies_and_edge_cases(spark):
    v, inf, nan = [1.0, 2.0, 3.0], float("inf"), float("nan")
    rows = [
        (1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0, 0.0, 0.0], 0),
        (8, [], 0), (9, [1.0, nan, 2.0], 0), (10, [1.0, None, 2.0], 0), (11, [inf, 0.0, 0.0], 0), (12, [1.0, 2.0], 0),
        (13, [3e38, 3e38, 0.0], 2), (14, [3e38, 3e38, 1e37], 2), (15, [-1.0, -2.0, -3.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS rep", "3 AS component", "true AS usable")
    got = embeddings.near_duplicates(df)
    assert result(got) == brute.near_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    null_ids = embeddings.near_duplicates(spark.createDataFrame([(None, v, 0), (None, v, 0), (1, v, 0)], SCHEMA)).collect()
    assert sorted((r.vec_id or 0, r.n_links) for r in null_ids) == [(0, 0), (0, 0), (1, 0)]


def test_passes_grow_with_the_table():
    counts = [embeddings.passes_for(10**k) for k in range(10)]
    assert counts == sorted(counts) and counts[0] == 1 and counts[-1] > 50


def cone(rng, n, mutual, pairs, dim=64):
    """Unit vectors of a mutual cosine, and partners of the first ones at a cosine of 0.93 or a little more."""
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    axis = unit(rng.standard_normal(dim))
    off = rng.standard_normal((n, dim))
    off = unit(off - (off @ axis)[:, None] * axis)
    some = mutual**0.5 * axis + (1 - mutual) ** 0.5 * off
    step = rng.standard_normal((pairs, dim))
    step = unit(step - (step * some[:pairs]).sum(1, keepdims=True) * some[:pairs])
    cosine = 0.9305
    return np.concatenate([some, cosine * some[:pairs] + (1 - cosine**2) ** 0.5 * step])


@pytest.mark.parametrize("mutual, blocks_for", [(0.7, 8), (0.7, 0.05), (0.8, 8), (0.85, 8)])
def test_recall_within_a_cone(spark, monkeypatch, mutual, blocks_for):
    """Vectors of one label close around one axis, with pairs at the threshold; by blocks and by further passes."""
    monkeypatch.setattr(embeddings, "BLOCKS_FOR", blocks_for)
    vectors = cone(np.random.default_rng(5), 4000, mutual, 400)
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(vectors)]
    want = brute.near_vectors(rows)
    got = result(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    links = sum(n for n, _ in want.values())
    assert links >= 800
    assert sum(n for n, _ in got.values()) >= 0.99 * links
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


def bridged(rng, groups, size, dim=64, between=0.915, noise=0.14):
    """Pairs of dense groups whose centres are below the threshold, so that few links cross between them."""
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    out = []
    for _ in range(groups):
        one = unit(rng.standard_normal(dim))
        off = rng.standard_normal(dim)
        off = unit(off - (off @ one) * one)
        for centre in (one, between * one + (1 - between**2) ** 0.5 * off):
            out.append(unit(centre + noise * rng.standard_normal((size, dim)) / dim**0.5))
    return np.concatenate(out)


@pytest.mark.parametrize("parts", [1, 64])
def test_bridges_between_dense_groups(spark, parts):
    """Every link that crosses between two dense groups counts, and joins them, from any partitioning."""
    rng = np.random.default_rng(8)
    vectors = bridged(rng, 6, 250)
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(vectors)]
    want = brute.near_vectors(rows)
    v = np.array([r[1] for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    cross = sum(int((v[500 * g : 500 * g + 250] @ v[500 * g + 250 : 500 * g + 500].T >= 0.93).sum()) for g in range(6))
    assert 0 < cross < 2000
    assert result(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(parts))) == want
