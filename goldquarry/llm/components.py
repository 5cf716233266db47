"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: every node hangs its larger neighbours, then its
smaller ones, on the smallest of them, until nothing changes. Each step is one aggregate with a
partial sum per task and one join, so a node with many neighbours is no task of its own. Every
round is written to the shared folder; nothing is collected.
"""

from pyspark.sql import DataFrame, functions as F

from goldquarry.sources.stages import drop_stage, write_stage


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()


def _written(df: DataFrame, name: str, used: list[str]) -> DataFrame:
    path = write_stage(df, name)
    used.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame, used: list[str]) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    # Stored, so that both sides of the join are plain and a hot node's rows can be split.
    least = _written(least.select("a", F.least("a", "least").alias("least")), "large-star", used)
    hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.distinct()


def _small_star(edges: DataFrame, used: list[str]) -> DataFrame:
    least = _written(edges.groupBy("a").agg(F.min("b").alias("least")), "small-star", used)
    hung = edges.join(least, "a").where("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the edges (a, b); component is its smallest node.

    Edges with a null end and loops are left out. No edges give no rows.
    """
    spark = edges.sparkSession
    known = edges.where("a is not null and b is not null and a <> b")
    plain = known.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    used: list[str] = []
    current = _written(plain.distinct(), "edges", used)
    before = _state(current)
    while before[0]:
        old, used = used, []
        # Both steps of a round are written; the rounds before it are removed.
        large = _written(_large_star(current, used), "large", used)
        current = _written(_small_star(large, used), "small", used)
        for path in old:
            drop_stage(spark, path)
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
