import re

import brute
import corpus_pipeline
import pytest

from goldquarry.llm import language
from goldquarry.llm.common import stage

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Input and output of every stage over a whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, apply in corpus_pipeline.STAGES:
        result = stage(apply(spark, docs, sf_dir), name)
        out[name] = (docs, result)
        docs = result
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns_stay(stages, spark, sf_dir):
    want = spark.read.parquet(f"{sf_dir}/documents.parquet").dtypes
    assert all(result.dtypes == want for _, result in list(stages.values())[:-1])


def test_language_stage_keeps_clean_documents(stages):
    docs, kept = stages["language_id"]
    assert kept.count() == docs.where("text IS NOT NULL").count()


def test_near_copies_stage(stages):
    docs, kept = stages["minhash_dedup"]
    components = brute.near_documents(texts(docs))
    assert set(texts(kept)) == {d for d, (_, c) in components.items() if d == c}


def test_repeats_stage(stages):
    docs, kept = stages["suffix_dedup"]
    before, after = texts(docs), texts(kept)
    removed = {d: n for d, _, n, _, _ in brute.without_repeats(list(before.items()))}
    assert all(after[d] == before[d] for d in before if not removed[d])
    assert set(before) - set(after) <= {d for d in before if removed[d] >= len(before[d].encode()) - 3}
    assert sum(removed.values()) > 0
    assert all(r.n_chars == len(r.text) for r in kept.collect())


def test_benchmark_stage(stages, spark, sf_dir):
    docs, kept = stages["decontamination"]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = {tuple(w[i : i + 10]) for w in map(words, items) for i in range(len(w) - 9)}
    dirty = {d for d, t in texts(docs).items() for w in [words(t)] if any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))}
    assert set(texts(kept)) == set(texts(docs)) - dirty


def test_packing_stage(stages):
    docs, packed = stages["packing"]
    rows = packed.collect()
    assert {r.doc_id for r in rows} == set(texts(docs))
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024


def test_run_is_the_stages(stages, spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.exceptAll(stages["packing"][1]).count() == 0 and got.count() == stages["packing"][1].count()


def test_edge_cases(spark, tmp_path):
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    long = "This text is surely long enough to be more than fifty bytes of one language."
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "12 34", "en", "s", 5), (4, long, "en", "s", 1), (4, long, "en", "s", 1),
            (5, long, "de", None, None), (None, long + " Other", "en", "s", 3), (6, "x one two three four five six seven eight nine TEN y", None, "s", 9),
            (7, long + " And yet another end that is long enough to be no near copy of it at all, is it?", "en", "t", 1)]
    docs = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'c' AS kept", "1 AS score", "2 AS crc", "3 AS spans", "4 AS n")
    columns = docs.columns
    seen = {}
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, str(tmp_path)), name)
        seen[name] = sorted((r.doc_id or 0 for r in docs.collect()))
        assert docs.columns == columns or name == "packing"
    assert seen["language_id"] == [0, 4, 4, 5, 6, 7]
    assert seen["minhash_dedup"] == [0, 4, 6, 7]
    assert seen["suffix_dedup"] == [0, 4, 6, 7]
    assert seen["decontamination"] == [0, 4, 7] == sorted(set(seen["packing"]))


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], COLUMNS)
    for name, apply in corpus_pipeline.STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
        assert docs.count() == 0


def test_held_out_rows_are_not_learned_from(spark):
    rows = [(i, "alpha beta" if i % 2 else "Привет мир", "aa" if i % 2 else "bb") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = df.where(~language.held_out(df.doc_id)).count()
    assert 0 < kept < 60
