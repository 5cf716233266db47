"""URL filter: host and path rules first, then logistic regression on hashed character n-grams.

DataFrame functions and Spark ML only. Rules are a short list given as a parameter. The model is
fitted on a small labelled URL table; scoring is one narrow pass without a shuffle, so a host with
a third of all urls costs nothing extra.
"""

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 1 << 14
GRAMS = (3, 4)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for a null url or one without "://"."""
    after = F.when(url.contains("://"), F.regexp_replace(url, "^(?s).*?://", "")).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, "^([^/?#]*)", 1)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_columns(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits; rules: (verdict, "host/path")."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rest = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rest}")
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def char_grams(chars: Column, sizes=GRAMS) -> Column:
    """All n-grams of an array of characters."""

    def grams(n):
        gram = lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)])
        return F.when(
            F.size(chars) >= n, F.transform(F.sequence(F.lit(0), F.size(chars) - n), gram)
        ).otherwise(F.array().cast("array<string>"))

    return reduce(F.concat, [grams(n) for n in sizes])


def _features(df: DataFrame, host: str, path: str) -> DataFrame:
    """Hashed n-grams of host and path, with a mark at either end."""
    marked = F.concat(F.lit("^"), F.col(host), F.col(path), F.lit("$"))
    # A column of its own: the n-grams look up characters by place, and a text is split once.
    chars = df.withColumn("_chars", F.filter(F.split(marked, ""), lambda c: c != ""))
    words = chars.withColumn("_grams", char_grams(F.col("_chars")))
    hashed = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=BUCKETS, binary=True)
    return hashed.transform(words)


def fit_url_model(labelled: DataFrame):
    """A model of `block` from a small labelled table (url, label 0 or 1); a number if only one label occurs.

    Rows with a null label are left out. Without any labelled row every url is allowed.
    """
    host, path = host_and_path(F.col("url"))
    table = labelled.where(F.col("label").isNotNull()).select(
        host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label")
    )
    # Few rows in one fixed order: the fitted numbers don't depend on the partitioning.
    rows = table.coalesce(1).sortWithinPartitions("host", "path", "label")
    seen = [r[0] for r in table.select("label").distinct().limit(2).collect()]
    if len(seen) < 2:
        return seen[0] if seen else 0.0
    fit = LogisticRegression(
        featuresCol="_features", labelCol="label", regParam=0.001, maxIter=50, probabilityCol="_probability",
        rawPredictionCol="_raw", predictionCol="_predicted",
    )
    return fit.fit(_features(rows, "host", "path"))


def judge_urls(pages: DataFrame, model, rules, page="page_id", url="url") -> DataFrame:
    """page_id, host, path, rule, verdict and block_score for every row.

    A rule's verdict stands; other urls are blocked at a score of one half or more. Null urls and
    urls without "://" have empty host and path and are judged by the model like any other.
    Repeated rows each get a row; other columns are ignored.
    """
    host, path = host_and_path(F.col(url))
    parts = pages.select(F.col(page).alias("page_id"), host.alias("host"), path.alias("path"))
    if isinstance(model, float):
        scored = parts.withColumn("block_score", F.lit(model))
    else:
        scored = model.transform(_features(parts, "host", "path")).withColumn(
            "block_score", vector_to_array("_probability")[1]
        )
    name, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, learned).alias("verdict"), "block_score"
    )
