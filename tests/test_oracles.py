"""Every catalogue query against its SQL on the generated tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _sorted(rows):
    return sorted(rows, key=repr)


# The library's own catalogue; queries of optional parts have their own tests.
@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = _sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    assert name in entry.oracle_sql()
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = _sorted(tuple(_plain(r[i]) for i in places) for r in cursor.fetchall())
    assert got == want


def test_entry_returns_rows(spark):
    assert entry.entry(spark).columns == ["dimension", "value", "count", "min_count"]
