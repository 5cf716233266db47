import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldquarry.llm import queries, url_filter

SCHEMA = "page_id long, url string"
RULES = queries.URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    fits = [(len(r), r, v) for v, r in RULES for h, _, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


HARD = [
    None, "", "no scheme", "http://", "http://Net/", "http://net", "https://A.NET/x?y#z", "x://y://z/w", "http://example.net/en/1",
    "http://sub.example.net/en", "http://example.net/en/", "http://notexample.com/de/", "http://www.example.com/de/a", "http://a.org/fr/",
    "http://org/fr/x", "http://morg/fr/", "http://h?q/net/", "http://h#f", "//net/", "http://user@a.net:80/p", "http://ÄÖ.net/É", "http://a\n.net/b\nc",
]


def judged(spark, sf_dir):
    return {r.page_id: r for r in queries.op6_url_filter(spark, sf_dir).collect()}


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url").collect()
    got = judged(spark, sf_dir)
    assert len(got) == len(pages)
    for p in pages:
        r = got[p.page_id]
        name, verdict = rule(*split(p.url))
        assert (r.host, r.path, r.rule) == (*split(p.url), name)
        assert r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))
    assert {r.verdict for r in got.values()} == {"allow", "block"}


def test_rules_and_odd_urls(spark):
    df = spark.createDataFrame(list(enumerate(HARD)), SCHEMA).selectExpr("*", "1 AS host", "2 AS rule", "3 AS _grams")
    got = {r.page_id: r for r in url_filter.judge_urls(df, 0.0, RULES).collect()}
    for i, url in enumerate(HARD):
        name, verdict = rule(*split(url))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (*split(url), name, verdict or "allow"), url


def test_model_separates_what_it_was_shown(spark):
    rows = [(f"http://casino{i}.example.com/win/{i}", 1) for i in range(40)] + [(f"http://library{i}.example.com/books/{i}", 0) for i in range(40)]
    model = url_filter.fit_url_model(spark.createDataFrame([*rows, ("http://x", None)], "url string, label int"))
    new = [(1, "https://m.casino99.example.com/win/99"), (2, "https://library77.example.com/books/7"), (3, None), (1, "https://m.casino99.example.com/win/99")]
    got = [(r.page_id, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(new, SCHEMA), model, []).collect()]
    assert sorted(got)[:3] == [(1, "block"), (1, "block"), (2, "allow")] and len(got) == 4


def test_score_is_the_logistic_function_of_the_grams(spark):
    rows = [(f"http://a{i}.com/x{i}", i % 2) for i in range(30)]
    model = url_filter.fit_url_model(spark.createDataFrame(rows, "url string, label int"))
    text = "a7.com/x7"
    marked = f"^{text}$"
    grams = {marked[i : i + n] for n in (3, 4) for i in range(len(marked) - n + 1)}
    df = spark.createDataFrame([("a7.com", "/x7")], "host string, path string")
    vector = url_filter._features(df, "host", "path").first()
    assert set(vector["_grams"]) == grams
    z = sum(model.coefficients[int(i)] for i in vector["_features"].indices) + model.intercept
    got = url_filter.judge_urls(spark.createDataFrame([(1, "http://a7.com/x7")], SCHEMA), model, []).first().block_score
    assert got == pytest.approx(1 / (1 + np.exp(-z)))


@pytest.mark.parametrize("labels,verdict", [([], "allow"), ([0, 0], "allow"), ([1], "block"), ([None], "allow")])
def test_tables_with_fewer_than_two_labels(spark, labels, verdict):
    table = spark.createDataFrame([("http://a", x) for x in labels], "url string, label int")
    model = url_filter.fit_url_model(table)
    assert url_filter.judge_urls(spark.createDataFrame([(1, "http://b")], SCHEMA), model, []).first().verdict == verdict


def test_empty_table_and_long_url(spark):
    model = url_filter.fit_url_model(spark.createDataFrame([("http://a", 0), ("http://b", 1)], "url string, label int"))
    assert url_filter.judge_urls(spark.createDataFrame([], SCHEMA), model, RULES).collect() == []
    long = "http://a/" + "x" * 300_000
    row = url_filter.judge_urls(spark.createDataFrame([(1, long)], SCHEMA), model, RULES).select(F.length("path").alias("n"), "verdict").first()
    assert row.n == 300_001 and row.verdict in ("allow", "block")


def test_a_repeated_url_does_not_fill_the_labelled_table(spark, sf_dir, tmp_path):
    """One decided url in a third of all rows: the other urls are judged as without its copies."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    name, _ = url_filter.rule_columns(*url_filter.host_and_path(F.col("url")), RULES)
    hot = pages.where(name.isNotNull()).orderBy("page_id").first().url
    copies = spark.range(pages.count() // 2).select((F.col("id") + 10**9).alias("page_id"), F.lit(hot).alias("url"))
    pages.unionByName(copies).write.parquet(f"{tmp_path}/pages.parquet")
    before, after = judged(spark, sf_dir), judged(spark, str(tmp_path))
    assert {k: r.verdict for k, r in after.items() if k < 10**9} == {k: r.verdict for k, r in before.items()}
