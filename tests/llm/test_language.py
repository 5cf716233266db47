import numpy as np
import pytest

from goldquarry.llm import language, queries

SCHEMA = "doc_id long, text string, lang string"


@pytest.mark.parametrize("seed", range(12))
def test_viterbi_is_exact(monkeypatch, seed):
    """Against one path after another, with texts of no, few and many words and short blocks."""
    rng = np.random.default_rng(seed)
    monkeypatch.setattr(language, "BLOCK", int(rng.integers(1, 6)))
    languages = int(rng.integers(1, 5))
    sizes = rng.integers(0, 14, 12)
    scores = rng.standard_normal((int(sizes.sum()), languages)) * 3
    first = np.append(0, np.cumsum(sizes))
    labels = language.viterbi(scores, first, penalty=2.5)
    for a, b in zip(first, first[1:]):
        if a == b:
            continue
        value = scores[a].copy()
        for t in range(a + 1, b):
            value = scores[t] + np.maximum(value, value.max() - 2.5)
        path = labels[a:b]
        total = scores[np.arange(a, b), path].sum() - 2.5 * (np.diff(path) != 0).sum()
        assert total == pytest.approx(value.max())


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    rows = queries.op4_language_id(spark, sf_dir).join(docs, "doc_id").where("held_out AND text IS NOT NULL").collect()
    right = sum(r.lang_pred == r.lang for r in rows)
    assert len(rows) > 150 and right >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_predictions_use_the_text_only(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = queries.fit_on_training_part(docs)
    changed = docs.selectExpr("doc_id + 1000000 AS doc_id", "text", "'xx' AS lang", "'s' AS source")
    before = sorted((r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, model).collect())
    after = sorted((r.doc_id - 1000000, r.lang_pred, r.score) for r in language.identify(changed, model).collect())
    assert before == after


def model_of(spark):
    texts = {"en": "the house and the garden with this thing", "de": "das haus und der garten mit diesem ding", "ru": "дом и сад с этой вещью"}
    rows = [(i, t, lang) for i, (lang, t) in enumerate(list(texts.items()) * 20)]
    return language.fit_languages(spark.createDataFrame(rows, SCHEMA))


def test_scripts_spans_and_edge_cases(spark):
    model = model_of(spark)
    text = "The house and the garden. Das Haus und der Garten mit diesem Ding! Это дом и сад с вещью, 12"
    rows = [(1, text, None), (2, None, "en"), (3, " 123 !\n", "en"), (4, "", "en"), (None, "дом", "en"), (5, "日本語", None), (1, text, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS spans", "3 AS words")
    got = language.identify(df, model, spans=True).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert [(text[s.start : s.end], s.lang) for s in by_id[1].spans] == [
        ("The house and the garden", "en"), ("Das Haus und der Garten mit diesem Ding", "de"), ("Это дом и сад с вещью", "ru"),
    ]
    assert by_id[1].lang_pred == "de" and 0.3 < by_id[1].score < 0.6
    assert [(by_id[k].lang_pred, by_id[k].score) for k in (2, 3, 4)] == [("und", 0.0)] * 3
    assert (by_id[None].lang_pred, by_id[None].score) == ("ru", 1.0)
    assert by_id[5].lang_pred in ("de", "en", "ru")
    assert language.identify(spark.createDataFrame([], SCHEMA), model).collect() == []


def test_nothing_to_learn_from(spark):
    model = language.fit_languages(spark.createDataFrame([(1, "a b", None), (2, None, "en")], SCHEMA))
    got = language.identify(spark.createDataFrame([(1, "a b", None)], SCHEMA), model, spans=True).collect()
    assert [(r.lang_pred, r.score, r.spans) for r in got] == [("und", 0.0, [])]


def test_long_text(spark):
    model = model_of(spark)
    text = "the house and the garden " * 100_000 + "das haus und der garten " * 50_000
    row = language.identify(spark.createDataFrame([(1, text, None)], SCHEMA), model, spans=True).first()
    assert row.lang_pred == "en" and [s.lang for s in row.spans] == ["en", "de"]


def test_many_languages_and_parts(monkeypatch):
    """300 labels, in parts of a few blocks, against all at once and against one path after another."""
    rng = np.random.default_rng(7)
    sizes = rng.integers(0, 200, 30)
    scores = rng.standard_normal((int(sizes.sum()), 300)) * 3
    scores[:, 250] += 2.0
    first = np.append(0, np.cumsum(sizes))
    whole = language.viterbi(scores, first, penalty=4.0)
    monkeypatch.setattr(language, "HELD_NUMBERS", 300 * 300 * 5)
    assert (language.viterbi(scores, first, penalty=4.0) == whole).all()
    assert whole.min() >= 0 and whole.max() > 200
    for a, b in zip(first, first[1:]):
        if a < b:
            value = scores[a].copy()
            for t in range(a + 1, b):
                value = scores[t] + np.maximum(value, value.max() - 4.0)
            assert scores[np.arange(a, b), whole[a:b]].sum() - 4.0 * (np.diff(whole[a:b]) != 0).sum() == pytest.approx(value.max())


def test_more_than_127_languages_are_told_apart(spark):
    rng = np.random.default_rng(2)
    words = [["".join(chr(97 + c) for c in rng.integers(0, 26, 5)) for _ in range(6)] for _ in range(200)]
    rows = [(i, " ".join(rng.choice(words[i % 200], 20)), f"l{i % 200:03d}") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = language.identify(df, language.fit_languages(df)).collect()
    wanted = {i: name for i, _, name in rows}
    assert sum(r.lang_pred == wanted[r.doc_id] for r in got) >= 0.97 * len(rows)
