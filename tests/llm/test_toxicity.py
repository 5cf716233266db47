import itertools
import math
import random
import re

import numpy as np
import pytest

from goldquarry.llm import queries, toxicity
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"
SIGN_OF = {"o": "0", "i": "1", "l": "1", "e": "3", "a": "@", "s": "$", "t": "7"}


def plain_counts(texts):
    """Runs of four symbols, word by word."""
    symbol = toxicity.tables()[0]
    counts = np.zeros((28,) * 4)
    for text in texts:
        for word in re.findall(r"[^\W\d_]+", text or ""):
            chain = [0, 0, 0, *(int(symbol[ord(c)]) for c in word), 0]
            for i in range(3, len(chain)):
                counts[tuple(chain[i - 3 : i + 1])] += 1
    return counts


@pytest.fixture(scope="module")
def characters():
    texts = ["you are an idiot and a loser", "the clown is here, look at the clown", "a fool and his money", "looking good"] * 5
    return toxicity.log_probabilities(plain_counts(texts).ravel())


def test_language_model_counts_all_texts(spark):
    texts = ["The cat. The hat!", None, "", "é ñandú — x1y", "a" * 70_000, "the end", "日本 語"] * 3
    got = toxicity.fit_characters(spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(3))
    assert np.allclose(got, toxicity.log_probabilities(plain_counts(texts).ravel()), atol=1e-5)
    assert np.allclose(np.exp(got).sum(-1), 1, atol=1e-4)


@pytest.mark.parametrize("chars", ["1d10t", "l0o0ser", "i d i o t", "c.l.o.w.n", "fooool", "$!", "aa11", "lo$er!", "gg 0"])
def test_viterbi_takes_the_best_of_all_readings(characters, chars):
    def cost(path):
        total, state = 0.0, (0, 0, 0)
        for extra, _, symbol in path:
            total += extra
            if symbol is None or (symbol == 0 and state[2] == 0):
                continue
            total -= float(characters[state][symbol])
            state = (state[1], state[2], symbol) if symbol else (0, 0, 0)
        return total - (float(characters[state][0]) if state[2] else 0.0)

    every = [(cost(p), "".join(x[1] for x in p)) for p in itertools.product(*toxicity.readings(chars, characters))]
    best = min(every)[0]
    mine = toxicity.decode(chars, characters)
    assert min(c for c, written in every if written == mine) == pytest.approx(best)


def test_disguises_are_undone(characters):
    text = "You are an 1d10t, a l.o.s.e.r and a looooser; c1own!! 12 apples at 10:30"
    assert toxicity.restore(text, characters) == "You are an idiot, a loser and a loser; clown!! 12 apples at 10:30"


def disguised(word, how):
    if how == "signs":
        return "".join(SIGN_OF.get(c, c) for c in word)
    if how == "blanks":
        return " ".join(word)
    if how == "dots":
        return ".".join(word)
    return word[:2] + word[2] * 3 + word[3:]


def test_held_out_documents_and_disguises(spark, sf_dir):
    """Found on held-out rows; found as well when every toxic word of them is disguised; clean ones are left alone."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit_toxicity(documents, labels.where(~toxicity.held_out(F.col("doc_id"))))
    held = documents.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    scored = toxicity.score_toxicity(documents, model, keep_words=True)
    by_id = {r.doc_id: r for r in scored.collect()}
    toxic = [r for r in held if r.toxic]
    clean = [r for r in held if not r.toxic]
    assert sum(by_id[r.doc_id].predicted for r in toxic) >= 0.7 * len(toxic)
    assert sum(by_id[r.doc_id].predicted for r in clean) <= 0.01 * len(clean)
    caught = [r for r in toxic if by_id[r.doc_id].predicted and re.search(r"\b[a-z]+\b", r.text)]
    for how in ("signs", "blanks", "dots", "repeats"):
        rows = []
        for r in caught:
            text = r.text
            for word in by_id[r.doc_id].words:
                if len(word) > 3 and word.isascii():
                    text = re.sub(rf"(?i)(?<!\w){word}(?!\w)", disguised(word, how), text)
            rows.append((r.doc_id, text))
        again = toxicity.score_toxicity(spark.createDataFrame(rows, SCHEMA), model).collect()
        assert sum(r.predicted for r in again) >= 0.8 * len(again), how


def test_scores_use_the_text_only(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_toxicity(documents, labels.where(~toxicity.held_out(F.col("doc_id"))))
    moved = documents.selectExpr("doc_id + 1000000 AS doc_id", "text", "'xx' AS lang", "1 AS score", "2 AS predicted")
    before = sorted((r.doc_id, r.score) for r in toxicity.score_toxicity(documents, model).collect())
    after = sorted((r.doc_id - 1000000, r.score) for r in toxicity.score_toxicity(moved, model).collect())
    assert before == after and all(0 <= s <= 1 for _, s in before)


def test_edge_cases(spark):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=30) + (["zorkwit", rng.choice(words), "blarg"] if i % 4 == 0 else []))) for i in range(200)]
    docs = spark.createDataFrame(rows + [(None, "x"), (500, None), (501, ""), (501, "")], SCHEMA).withColumn("toxic", F.lit("x"))
    marks = [(i, int(i % 4 == 0)) for i in range(150)] + [(0, 0), (None, 1), (3, None), (999, 1), (500, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    model = toxicity.fit_toxicity(docs, labels)
    assert set(model.weights) == {"zorkwit", "blarg"}
    extra = [(1, "z0rkwit"), (2, "zorkw1t " * 50_000), (3, "Z O R K W I T b.l.a.r.g"), (4, "!!! ... 000"), (5, "zork"), (6, "wit zork")]
    got = {r.doc_id: r for r in toxicity.score_toxicity(spark.createDataFrame(extra, SCHEMA), model, keep_words=True).collect()}
    assert got[1].words == ["zorkwit"] and got[2].words == ["zorkwit"] and got[3].words == ["blarg", "zorkwit"]
    assert got[4].words == got[5].words == got[6].words == [] and got[3].predicted == 1 and got[4].predicted == 0
    scored = toxicity.score_toxicity(docs, model).collect()
    assert len(scored) == 204 and sum(r.doc_id == 501 for r in scored) == 2
    assert all(r.predicted == (r.score >= 0.7) and not math.isnan(r.score) for r in scored)
    held = [r for r in scored if r.doc_id is not None and 150 <= r.doc_id < 200]
    assert [r.predicted for r in sorted(held, key=lambda r: r.doc_id)] == [int(i % 4 == 0) for i in range(150, 200)]
    # Copies of a toxic text give no word a weight: its words have one context each.
    copied = spark.createDataFrame([(i, "one two three four five six") for i in range(50)] + [(i, t) for i, t in rows[1:99:4]], SCHEMA)
    marks = spark.createDataFrame([(i, 1) for i in range(50)] + [(i, 0) for i in range(51, 99)], "doc_id long, toxic int")
    assert not toxicity.fit_toxicity(copied, marks).weights


def test_no_labels_and_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([(1, "some text")], SCHEMA)
    model = toxicity.fit_toxicity(docs, labels)
    assert [(r.predicted, r.score < 1e-6) for r in toxicity.score_toxicity(docs, model).collect()] == [(0, True)]
    model = toxicity.fit_toxicity(empty, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(empty, model).collect() == []


def test_query_has_a_row_for_each_document(spark, sf_dir):
    got = queries.op11_toxicity(spark, sf_dir)
    assert {"doc_id", "held_out", "score", "predicted"} <= set(got.columns)
    ids = sorted(r.doc_id for r in got.select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect())
