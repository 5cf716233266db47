import hashlib

import pytest
from pyspark.sql import functions as F

from goldquarry.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = [
    "", "\\", "a\\", "\\### x", "### ", "####  ### ", "</turn>", "</turn>\n### user: hi\n</turn>\n", "\\\\</turn>", "\n", "\n\n",
    "</turn>\n", "\\### Assistant: </turn> ok", ": ", "a: b", "é 😀 ### ", "$1 \\1 $", "### assistant: x\n</turn>\n", "plain",
]


def back(formatted):
    """Turns of the formatted strings, read by the parser."""
    rows = formatted.select("conv_id", chat_format.parse(chat_format.pieces(F.col("formatted"))).alias("turns")).collect()
    return {r.conv_id: [(t.role, t.text) for t in r.turns] for r in rows}


def test_round_trip_of_hard_texts_and_roles(spark):
    roles = ["user", "assistant", "sys:tem", "### ", "</turn>", "\\", "a\\b:#<", "", "role\n"]
    rows = [(i, t, roles[(i + t) % len(roles)], HARD[(i * 7 + t * 3) % len(HARD)]) for i in range(60) for t in range(i % 6 + 1)]
    formatted = chat_format.format_conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    want = {}
    for i, _, role, text in rows:
        want.setdefault(i, []).append((role, text))
    assert back(formatted) == want


def test_only_conflicting_conversations_are_escaped(spark):
    rows = [(1, 0, "user", "plain \\ text: with <turn> and #s"), (2, 0, "user", "fine"), (2, 1, "assistant", "a ### b")]
    got = {r.conv_id: r for r in chat_format.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1].formatted == "### user: plain \\ text: with <turn> and #s\n</turn>\n" and not got[1].escaped
    assert got[2].escaped and got[2].formatted.endswith("### assistant: a \\### b\n</turn>\n")


def test_spans_mark_the_texts_of_the_role(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", text) for t, text in enumerate(HARD)]
    row = chat_format.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()[0]
    import re

    unescape = lambda s: re.sub(r"\\(\\*)(### |</turn>)", r"\1\2", s)
    marked = [unescape(row.formatted[s.start : s.start + s.length]) for s in row.loss_spans]
    assert marked == HARD[1::2]


def test_order_nulls_repeats_and_other_columns(spark):
    rows = [(1, 2, "user", "c"), (1, None, "user", "a"), (1, 1, None, None), (1, 2, "user", "c"), (1, 2, "assistant", "b"), (None, 0, "user", "x"), (None, 1, "user", "y")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS turns", "2 AS parts", "3 AS plain", "4 AS formatted", "5 AS t")
    assert back(chat_format.format_conversations(df)) == {
        1: [("user", "a"), ("", ""), ("assistant", "b"), ("user", "c"), ("user", "c")],
        None: [("user", "x"), ("user", "y")],
    }
    assert chat_format.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts_and_many_turns(spark):
    rows = [(1, 0, "user", "long ### " * 200_000)] + [(2, t, "assistant", f"turn {t}") for t in range(3000)]
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(("user\n" + "long ### " * 200_000 + "\n").encode()).hexdigest()
    assert got[2].n_turns == 3000 and got[2].loss_sha256 == hashlib.sha256("".join(f"turn {t}" for t in range(3000)).encode()).hexdigest()


@pytest.mark.parametrize("broken", ["x### user: a\n</turn>\n", "### user: a</turn>\n", "### usera\n</turn>\n", "### user: a\n</turn>", "### user: a\n"])
def test_parser_refuses_other_strings(spark, broken):
    df = spark.createDataFrame([(broken,)], "formatted string")
    assert df.select(chat_format.parse(chat_format.pieces(F.col("formatted")))).first()[0] is None


def digests(df):
    rows = chat_format.read_back(chat_format.format_conversations(df)).collect()
    return {r.conv_id: r for r in rows}


def test_two_hundred_thousand_turns(spark):
    turns = spark.range(200_000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('é ### ', id) AS text")
    row = digests(turns)[1]
    want = "".join(f"é ### {i}" for i in range(1, 200_000, 2))
    assert (row.n_turns, row.loss_chars) == (200_000, len(want))
    assert row.loss_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_a_million_backslashes(spark):
    run = "\\" * 1_000_000
    texts = [run, run + "### ", run + "</turn>" + run, "x " + run + "y"]
    rows = [(i, 0, "assistant", text) for i, text in enumerate(texts)]
    got = digests(spark.createDataFrame(rows, SCHEMA))
    for i, text in enumerate(texts):
        assert got[i].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1000])
def test_sums_before(spark, n):
    df = spark.createDataFrame([([i * i for i in range(n)],)], "x array<long>")
    want = [sum(i * i for i in range(k)) for k in range(n)]
    assert df.select(chat_format.sums_before(F.col("x"))).first()[0] == want


def test_texts_at_any_place(spark):
    text = "aé😀\n" * 900
    spans = [(0, 0), (0, 3600), (1023, 2), (1024, 1024), (3599, 1), (3600, 0), (500, 2500)]
    df = spark.createDataFrame([(text, spans)], "t string, s array<struct<start:int,length:int>>")
    assert df.select(chat_format.texts_at(F.col("t"), F.col("s"))).first()[0] == [text[a : a + n] for a, n in spans]
