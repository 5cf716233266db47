import random

import brute
import pytest

from goldquarry.llm import kernels, minhash, queries

SCHEMA = "doc_id long, text string"


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def family(base, words, edits, rng):
    text = list(base)
    for _ in range(edits):
        text[rng.randrange(len(text))] = rng.choice(words)
    return " ".join(text)


def test_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = queries.op2_minhash_dedup(spark, sf_dir)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(found) == brute.near_documents(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def test_large_groups_and_common_passages(spark, monkeypatch):
    """Copies, edits of many strengths and a passage in every text, with lists cut into small blocks."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(120)]
    passage = " ".join(rng.choice(words) for _ in range(30))
    texts = [family(base, words, rng.randrange(0, 14), rng) for _ in range(150)]
    texts += [" ".join(base)] * 20
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(5, 90))) for _ in range(120)]
    docs = dict(enumerate(texts))
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 16)
    found = minhash.near_duplicates(spark.createDataFrame(list(docs.items()), SCHEMA).repartition(7))
    assert result(found) == brute.near_documents(docs)


def test_edge_cases(spark):
    rows = [(3, None), (4, ""), (5, " \t\n "), (6, "one two"), (7, "ONE  two"), (8, "one two three"), (9, "é Été x y z"),
            (10, "é Été X y z"), (11, "é été x y z"), (12, "a b c d e a b c d e a b c d e")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'s' AS sketch", "2L AS rep", "0 AS component")
    assert result(minhash.near_duplicates(df)) == brute.near_documents(dict(rows))
    assert minhash.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"x{i}" for i in range(40))
    rows = [(None, text), (1, text), (1, text), (2, text), (2, "another text of some words here")]
    found = sorted(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), key=repr)
    assert len(found) == 5
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id is not None) == [(1, 1), (1, 1), (2, 1), (2, 2)]


def test_long_text_and_word_hashes(spark):
    long = " ".join(f"word{i}" for i in range(300_000))
    rows = [(1, long), (2, long + " more"), (3, "short one")]
    assert result(minhash.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == {
        1: (299_996, 1), 2: (299_997, 1), 3: (1, 3),
    }


@pytest.mark.parametrize("text", ["a b a b a b a b a", "same same same same same same"])
def test_sets_are_distinct(spark, text):
    df = spark.createDataFrame([(1, text)], SCHEMA)
    assert result(minhash.near_duplicates(df))[1][0] == len(brute.shingles(text))


def test_hashes_of_equal_words_agree_across_slices(monkeypatch):
    import pyarrow as pa

    texts = pa.array([None, "Abc déf", "", "x abc DÉF", "déf"])
    monkeypatch.setattr(kernels, "SLICE_BYTES", 1 << 20)
    seen = []
    for _, data, offsets in kernels.text_slices(texts, limit=4):
        hashes, first = kernels.word_hashes(data, offsets, kernels.BLANK_SEPARATED)
        seen += [hashes[a:b].tolist() for a, b in zip(first, first[1:])]
    assert [len(s) for s in seen] == [0, 2, 0, 3, 1]
    assert seen[1][0] == seen[3][1] and seen[1][1] == seen[4][0] and seen[3][2] != seen[4][0]
