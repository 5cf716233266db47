"""A corpus pipeline: language, near copies, repeated passages, benchmark passages, packing.

Every stage takes all documents its predecessor kept and, but for the last, returns rows with the
columns of `documents`. Columns beyond those pass through. doc_id is the key of a document; decisions
about a doc_id hold for all its rows. Rows with a null doc_id are never near copies or repeats of
others, and stay.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from goldquarry.llm import decontaminate, language, minhash, packing, suffix_dedup
from goldquarry.llm.common import broadcast_if_small, stage
from goldquarry.llm.queries import SEQUENCE_TOKENS, fit_on_training_part

# Documents whose best language covers less of their letters are mixed text.
LEAST_LANGUAGE_SHARE = 0.5


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, so that their names meet no others."""
    return docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]).alias("carried"))


def _restored(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` again."""
    return df.select("doc_id", "text", "carried.*").select(*docs.columns)


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is none of `ids`."""
    return docs.join(broadcast_if_small(ids.select("doc_id").distinct()), "doc_id", "left_anti").select(*docs.columns)


def _one_row_each(docs: DataFrame) -> DataFrame:
    """Repeated rows of a doc_id with the same text become one; texts are moved for repeated doc_ids only."""
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 AND doc_id IS NOT NULL")
    repeated = stage(repeated.select("doc_id"), "repeated-ids")
    again = docs.join(broadcast_if_small(repeated), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return _without(docs, repeated).unionByName(again)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that have letters and one language with at least half of them."""
    predicted = language.identify(_carried(docs), fit_on_training_part(docs), keep_columns=True)
    kept = predicted.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SHARE))
    return _restored(kept, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of every group of near copies, once."""
    found = stage(minhash.near_duplicates(docs), "near-copies")
    dropped = found.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept")
    return _without(_one_row_each(docs), stage(dropped, "dropped-copies"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 50 bytes or more that an earlier document has; documents of which nothing remains go."""
    cut = suffix_dedup.remove_repeats(_carried(docs), keep_columns=True).withColumn("text", F.col("kept"))
    return _restored(cut.where("text <> ''"), docs).withColumn("n_chars", F.length("text").cast("long"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage of a benchmark item."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, stage(found.where("n_hit > 0").select("doc_id"), "contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), SEQUENCE_TOKENS)


STAGES = [
    ("language_id", identify_language),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]
# No SQL: the language model and the packing are not expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
