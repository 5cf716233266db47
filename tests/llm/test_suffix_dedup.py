import hashlib
import os
import random
import re

import brute
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from goldquarry.llm import queries, suffix_dedup
from goldquarry.llm.run_index import RunIndex, ragged

SCHEMA = "doc_id long, text string"


def result(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def test_whole_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = queries.op9_suffix_dedup(spark, sf_dir)
    assert result(found) == brute.without_repeats(docs)


def test_edits_periods_and_common_grams(spark):
    rng = random.Random(2)
    letters = "abcdeé "
    draw = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [draw(n) for n in (49, 50, 51, 60, 90, 200, 400)]
    texts = []
    for _ in range(150):
        parts = [draw(rng.randrange(0, 60)) for _ in range(4)] + rng.choices(passages, k=3)
        rng.shuffle(parts)
        text = list("".join(parts))
        for _ in range(rng.randrange(0, 4)):
            if text:
                text[rng.randrange(len(text))] = rng.choice(letters)
        texts.append("".join(text))
    texts += ["x" * n for n in (10, 49, 50, 51, 500, 300)] + ["ab" * 100, "ba" * 60, "", passages[4]]
    # One gram that is in many texts, each with its own bytes around.
    texts += [draw(25) + "the common gram of all" + draw(25) for _ in range(60)]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    assert result(suffix_dedup.remove_repeats(df)) == brute.without_repeats(docs)


def test_small_buckets_indexes_and_batches(spark, monkeypatch):
    rng = random.Random(4)
    base = "".join(rng.choice("abcdef ") for _ in range(3000))
    docs = []
    for i in range(60):
        start = rng.randrange(0, 2500)
        docs.append((i, base[start : start + rng.randrange(40, 500)]))
    for name, value in (("HELD", 50), ("INDEX_SYMBOLS", 300), ("STREAMED", 7), ("BUCKET_BYTES", 500)):
        monkeypatch.setattr(suffix_dedup, name, value)
    df = spark.createDataFrame(docs, SCHEMA)
    assert result(suffix_dedup.remove_repeats(df)) == brute.without_repeats(docs)


def test_edge_cases(spark):
    text = "Some text that is well over fifty bytes long, so that copies of it go."
    rows = [(1, text), (2, None), (3, text + " more"), (None, text), (4, ""), (4, text), (4, "é" * 30), (5, "x" + "é" * 30), (6, text), (6, text)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS crc", "2 AS rows", "3 AS _x", "4 AS n_bytes")
    got = suffix_dedup.remove_repeats(df, keep_columns=True)
    assert sorted(got.columns) == sorted(["doc_id", "crc", "rows", "_x", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    found = {(r.doc_id, r.n_bytes): (r.n_removed, r.kept) for r in got.collect()}
    n = len(text)
    assert found[1, n] == (0, text) and found[None, n] == (0, text)
    assert found[3, n + 5] == (n, " more") and found[4, n] == (n, "") and found[6, n] == (n, "")
    assert found[2, 0] == (0, "") and found[4, 0] == (0, "")
    assert found[4, 60] == (0, "é" * 30) and found[5, 61] == (60, "x")
    assert got.count() == len(rows)
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_removed_part_of_a_character(spark):
    # Both characters end with the same byte, so the copy begins inside the second text's.
    first = "é" + "q" * 60
    second = "z©" + "q" * 60
    got = suffix_dedup.remove_repeats(spark.createDataFrame([(1, first), (2, second)], SCHEMA))
    row = {r.doc_id: r for r in got.collect()}[2]
    data = second.encode()
    assert (row.n_removed, row.kept) == (61, "z")
    assert row.kept_sha256 == hashlib.sha256(data[:-61]).hexdigest()


def test_long_text(spark):
    rng = np.random.default_rng(1)
    long = bytes(rng.integers(97, 123, 3_000_000, dtype=np.uint8)).decode()
    docs = [(1, long), (2, "#" + long[1_000_000:2_000_000] + "#"), (3, long)]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.remove_repeats(spark.createDataFrame(docs, SCHEMA)).collect()}
    assert got == {1: (0, 0), 2: (1_000_000, 1), 3: (3_000_000, 1)}


@pytest.mark.parametrize("seed", range(6))
def test_run_index_finds_all_windows(seed):
    rng = np.random.default_rng(seed)
    strings = [rng.integers(0, 3, rng.integers(1, 40)) for _ in range(30)]
    patterns = [rng.integers(0, 4, rng.integers(1, 40)) for _ in range(40)] + strings[:5]
    index = RunIndex(np.concatenate(strings), np.array([len(s) for s in strings]))
    lengths = np.array([len(p) for p in patterns])
    k = 6
    got = index.has_windows(ragged(np.concatenate(patterns), lengths, 0), lengths, k)
    there = {tuple(s[i : i + k]) for s in strings for i in range(len(s) - k + 1)}
    for row, pattern in zip(got, patterns):
        want = [tuple(pattern[i : i + k]) in there for i in range(len(pattern) - k + 1)]
        assert row[: len(want)].tolist() == want and not row[len(want) :].any()
    # The positions are those of longest matches.
    places = index.positions(ragged(np.concatenate(patterns), lengths, 0), lengths)
    joined = [s.tolist() for s in strings]
    for row, pattern in zip(places, patterns):
        for i in range(len(pattern)):
            rest = pattern[i:].tolist()
            best = max(next((n for n in range(min(len(rest), len(s) - j)) if s[j + n] != rest[n]), min(len(rest), len(s) - j))
                       for s in joined for j in range(len(s)))
            n = 0
            while row[i] >= 0 and n < len(rest) and row[i] + n < len(index.text) and index.text[row[i] + n] == rest[n] + index.offset:
                n += 1
            assert n == best


def lines_in_all(n):
    """Texts with one line in all of them, some edges of it shared by few."""
    rng = random.Random(11)
    draw = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    line, edges = draw(300), [draw(20) for _ in range(n // 4)]
    return [(i, draw(60) + rng.choice(edges) + line + rng.choice(edges) + draw(60)) for i in range(n)]


def test_a_common_line_is_no_group():
    """However many documents have a line, few of its edges meet in one place."""
    ids, texts = zip(*lines_in_all(400))
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    sent = pa.Table.from_batches([*suffix_dedup._cut(1)([batch])])
    blobs = sent.filter(pc.field("kind") == "passages").column("rows").to_pylist()
    grams = suffix_dedup.unpack_columns(blobs, suffix_dedup.PASSAGE)["gram"]
    assert np.unique(grams, return_counts=True)[1].max() < 20


@pytest.mark.parametrize("often, very_common, held", [(3, 5000, 300), (16, 20, 1 << 17), (2, 3, 60)])
def test_windows_of_common_lines(spark, monkeypatch, often, very_common, held):
    for name, value in (("OFTEN", often), ("VERY_COMMON", very_common), ("COMMON_GRAM", 10), ("HELD", held)):
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = lines_in_all(200)
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    assert result(suffix_dedup.remove_repeats(df)) == brute.without_repeats(docs)


def test_shuffles_of_stored_stages_leave_the_disk(spark):
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefgh ", k=120))
    docs = [(i, line[: 60 + i % 60] + "".join(rng.choices("abcdefgh ", k=400))) for i in range(200)]
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {p for p in blocks.getAllFiles().mkString("\n").split() if re.search(r"/shuffle_\w+\.data$", p)}
    before = shuffled()
    found = suffix_dedup.remove_repeats(spark.createDataFrame(docs, SCHEMA))
    # What stays is the sum of the texts' lengths, a number from each task.
    assert sum(os.path.getsize(p) for p in shuffled() - before if os.path.exists(p)) < 2000
    assert result(found) == brute.without_repeats(docs)
