import random
import re

import pytest

from goldquarry.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for d, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            x = words(item_text)
            k = min(len(x), 10)
            for i in range(len(x) - k + 1 if k else 0):
                for j in range(len(w) - k + 1):
                    if w[j : j + k] == x[i : i + k]:
                        hit |= set(range(j, j + k))
                        found.add(str(item))
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    """Few different words, so that hits overlap, repeat and touch; items of all lengths."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "Z9"][: 2 + seed % 3] + [f"w{i}" for i in range(12 * (seed > 1))]
    draw = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, draw(n)) for i, n in enumerate([1, 2, 4, 5, 9, 10, 11, 14, 30, 60])] if seed % 2 else [(i, draw(n)) for i, n in enumerate([10, 12, 25, 60])]
    docs = [(i, draw(rng.randrange(0, 80))) for i in range(25)]
    docs += [(100 + i, draw(3) + "! " + items[-1][1][k : k + 90].upper() + ", " + draw(9)) for i, k in enumerate((0, 11, 40))]
    got = decontaminate.decontaminate(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS))
    assert result(got) == brute(docs, items)


def test_edge_cases(spark):
    ten = "one two three four five six seven eight nine ten"
    docs = [(1, ten), (1, ten), (2, None), (3, ""), (4, ten[:-4]), (None, ten + " more"), (5, "x " + ten.title().replace(" ", "--") + " " + ten), (6, "short item")]
    items = [(10, ten), (2, ten), (None, ten), (7, None), (8, "?!"), (9, "Short, ITEM")]
    dfs = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS row", "2 AS hits", "3 AS fp"), spark.createDataFrame(items, ITEMS)
    got = result(decontaminate.decontaminate(*dfs))
    ids = ["10", "2"]
    assert got == sorted([(1, 10, 10, ids), (1, 10, 10, ids), (2, 0, 0, []), (3, 0, 0, []), (4, 9, 0, []), (None, 11, 10, ids), (5, 21, 20, ids), (6, 2, 2, ["9"])], key=repr)
    none = decontaminate.decontaminate(dfs[0], spark.createDataFrame([], ITEMS))
    assert all(r[2] == 0 for r in result(none)) and none.count() == len(docs)
    assert decontaminate.decontaminate(spark.createDataFrame([], DOCS), dfs[1]).collect() == []


def test_long_text(spark):
    filler = " ".join(f"f{i}" for i in range(400_000))
    ten = "one two three four five six seven eight nine ten eleven"
    got = decontaminate.decontaminate(spark.createDataFrame([(1, f"{filler} {ten} {filler}")], DOCS), spark.createDataFrame([(1, ten)], ITEMS))
    row = got.first()
    assert (row.n_words, row.n_hit) == (800_011, 11)
    assert {i for p in row.passages for i in range(p.start, p.end)} == set(range(400_000, 400_011))
