import random

import numpy as np
import pytest

from goldquarry.llm import periodic
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


def brute(text):
    """(runs, collapsed) by trying every period at every place."""
    w = (text or "").encode().split()
    n, runs = len(w), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                runs.setdefault((i, j - i + q), q)
            i = max(j, i + 1) if j > i else i + 1
    found = sorted((s, m, q) for (s, m), q in runs.items())
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    found.sort(key=lambda r: (r[0], r[2]))
    return found, b" ".join(x for i, x in enumerate(w) if i not in gone).decode()


def texts():
    rng = random.Random(3)
    out = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "x " * 400, "a b " * 4, "a b " * 3 + "a", "z " + "a b c " * 4 + "q"]
    for k in range(300):
        alphabet = "ab" if k % 3 else "abcde"
        out.append(" ".join(rng.choice(alphabet) for _ in range(rng.randrange(80))))
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            block = [rng.choice("abcdefg") for _ in range(rng.randrange(1, 12))]
            whole = block * rng.randrange(1, 8)
            parts += whole[: rng.randrange(1, len(whole) + 1)] + [f"u{rng.random()}"] * rng.randrange(3)
        out.append(rng.choice([" ", "\n", " \t "]).join(parts))
    # Fibonacci words are as full of runs as can be.
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    out += [" ".join(b), "Ü é " * 9 + "   "]
    return out


@pytest.mark.parametrize("parts", [1, 5])
def test_against_brute_force(spark, parts):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).withColumns({"runs": F.lit(1), "n_words": F.lit("x")})
    got = {r.doc_id: r for r in periodic.find_runs(df).collect()}
    for key, text in rows:
        runs, collapsed = brute(text)
        assert [tuple(r) for r in got[key].runs] == runs, text
        assert got[key].collapsed == collapsed
        assert got[key].n_words - got[key].n_dropped == len(collapsed.encode().split())


def test_blocks_compared_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    w = np.concatenate([rng.integers(0, 2, 300), np.tile(rng.integers(0, 2, 30), 7), rng.integers(0, 2, 200)])
    text = " ".join(map(str, w))
    whole = lambda: periodic.runs_in(periodic.Rolling(w.astype(np.uint64) + 7), np.array([0]), np.array([len(w)]))
    want = whole()
    monkeypatch.setattr(periodic, "BLOCKS_AT_ONCE", 50)
    assert (whole() == want).all() and [tuple(r) for r in want.tolist()] == brute(text)[0]


def test_splitting_only_prunes(monkeypatch):
    """Segments hold every run, whether splitting goes to the end or stops early."""
    rng = np.random.default_rng(9)
    ids = np.concatenate([rng.integers(0, 40, 500), np.tile(rng.integers(0, 40, 9), 6), rng.integers(0, 300, 500)])
    first = np.array([0, 400, len(ids)])
    found = []
    for progress in (1 / 64, 0, 2):
        monkeypatch.setattr(periodic, "LEAST_PROGRESS", progress)
        starts, ends = periodic.surviving_segments(ids, first)
        found.append(periodic.runs_in(periodic.Rolling(ids.astype(np.uint64)), starts, ends).tolist())
    assert found[0] == found[1] == found[2] and found[0]


def test_long_texts_and_repeated_rows(spark):
    rng = np.random.default_rng(4)
    long = " ".join(map(str, np.concatenate([np.tile(rng.integers(0, 3, 50_000), 5), rng.integers(0, 10**9, 100_000)])))
    rows = [(1, long), (2, "ab " * 300_000), (None, "a a a a a a"), (3, "b b b b b b"), (3, "b b b b b b")]
    got = periodic.find_runs(spark.createDataFrame(rows, SCHEMA)).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 5 and by_id[2].runs[0] == (0, 300_000, 1) and by_id[2].collapsed == "ab"
    assert max(by_id[1].runs, key=lambda r: r.length) == (0, 250_000, 50_000)
    assert by_id[None].collapsed == "a"
    assert periodic.find_runs(spark.createDataFrame([], SCHEMA)).collect() == []
