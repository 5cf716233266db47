"""Every query with SQL against DuckDB over whole tables, and a row for each row that is owed one."""

import glob
import os

import duckdb
import pytest

from goldquarry.llm import queries


@pytest.fixture(scope="module")
def database(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, database, name):
    got = queries.QUERIES[name](spark, sf_dir)
    want = database.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert plain([tuple(r) for r in got.collect()], got.columns) == plain(want.fetchall(), columns)


def test_results_do_not_depend_on_partitions(spark, sf_dir):
    """Dealing work out differently changes no result."""
    names = ["op2_minhash_dedup", "op6_url_filter", "op7_decontamination", "op8_embedding_dedup", "op9_suffix_dedup"]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    for parts in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        results.append([sorted(map(repr, queries.QUERIES[n](spark, sf_dir).collect())) for n in names])
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]
