import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from goldquarry.llm import packing, queries

SCHEMA = "doc_id long, text string"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(VOCABULARY)
HARD = ["", " ", "  \n\n  x", "a" * 5000, "<|endoftext|>", "x<|endoftext|> y<|endoftext|>", "I'll we've 'S", "日本語 ́ 😀👍🏽", "\t1234567\r\n", "é" * 700, "<|endoftext", "!\x1c!\x1f \x1d?", "\x85\x85 a"]


def ids(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def plain_best_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(room, n)
        bisect.insort(room, room.pop(at) - n if at < len(room) else capacity - n)
    return room


def check(rows, docs, window):
    """Pieces hold every id once and in order, sequences are gapless and full enough."""
    pieces, filled, crcs = {}, {}, {}
    for r in sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id, r.start)):
        pieces.setdefault(r.doc_id, []).append(r)
    for d, text in docs.items():
        own, want = pieces.pop(d), ids(text)
        assert [r.start for r in own] == np.append(0, np.cumsum([r.length for r in own])[:-1]).tolist()
        assert sum(r.length for r in own) == len(want) and {r.doc_tokens for r in own} == {len(want)}
        assert [r.ids_crc32 for r in own] == [zlib.crc32(want[r.start : r.start + r.length].tobytes()) for r in own]
    assert not pieces
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
        crcs[r.sequence_id] = r.padded_length
    assert max(filled.values()) <= window
    for s, n in filled.items():
        assert crcs[s] == (n if n & (n - 1) == 0 else window)
    assert sorted(window - n for n in filled.values()) == plain_best_fit([r.length for r in rows], window)


def test_whole_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    check(queries.op3_packing(spark, sf_dir).collect(), docs, 1024)


def test_edge_cases(spark):
    docs = dict(enumerate([None, *HARD, *HARD]))
    df = spark.createDataFrame(list(docs.items()), SCHEMA).selectExpr("*", "1 AS length", "2 AS rank", "3 AS slice", "4 AS n")
    check(packing.pack(df, VOCABULARY, 64).collect(), docs, 64)
    assert packing.pack(spark.createDataFrame([], SCHEMA), VOCABULARY).collect() == []


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "some text"), (1, "some text"), (None, "x"), (None, None)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA), VOCABULARY, 16).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (0, 2), (1, 3), (1, 3)]
    assert sum(r.length for r in got) == 9 and len({(r.sequence_id, r.offset) for r in got}) == 4


def test_sequences_hold_the_ids(spark):
    rng = random.Random(1)
    docs = {i: " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(rng.randrange(0, 120))) for i in range(60)}
    packed = packing.pack(spark.createDataFrame(list(docs.items()), SCHEMA), VOCABULARY, 32, keep_ids=True)
    rows = packed.collect()
    check(rows, docs, 32)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in packing.sequences(packed).collect()}
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
        assert len(whole[r.sequence_id]) == r.padded_length


@pytest.mark.parametrize("seed", range(10))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 16, 100, 1024])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else rng.randint(1, max(1, capacity // 9)) for _ in range(rng.randint(1, 3000))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit_plan(counts, capacity)
    filled, used = {}, {}
    ranks = {n: set() for n in counts}
    for length, rank, pieces, first, each, offset, total in plan:
        for k in range(pieces):
            window = first + k // each
            assert filled.setdefault(window, {}).setdefault(offset + k % each * length, length) == length
            ranks[length].add(rank + k)
            assert used.setdefault(window, total) == total
    assert all(ranks[n] == set(range(counts[n])) for n in counts)
    for window, places in filled.items():
        at = 0
        for offset in sorted(places):
            assert offset == at
            at += places[offset]
        assert at == used[window] <= capacity
    assert sorted(capacity - n for n in used.values()) == plain_best_fit(lengths, capacity)
    assert len(plan) <= 10 * 3 * capacity


def test_tightest_window():
    tree = packing.OpenWindows(10)
    assert tree.tightest(0) is None
    for room in (3, 7, 7, 10):
        tree.add(room, 1)
    assert [tree.tightest(n) for n in range(11)] == [3, 3, 3, 3, 7, 7, 7, 7, 10, 10, 10]
    tree.add(7, -2)
    assert tree.tightest(4) == 10


@pytest.mark.parametrize("cut", [1, 3, 50])
def test_cutting_long_texts_keeps_the_ids(monkeypatch, cut):
    monkeypatch.setattr(packing, "CUT_CHARS", cut)
    for text in [*HARD, " ".join(HARD), "one  two\n\n three   " * 20]:
        if "<|endoftext" not in text:
            assert packing.token_ids(text, VOCABULARY).tolist() == ids(text).tolist()


@pytest.mark.parametrize("blank", [" ", "\n", "\t", " \n", "\u3000"])
def test_long_white_space(blank):
    """Three million blanks alone, and between and behind words."""
    run = blank * (3_000_000 // len(blank))
    for text in (run, f"a{run}b", f"one two {run}"):
        assert np.array_equal(packing.token_ids(text, VOCABULARY), ids(text))


def test_long_words():
    for text in ("a" * 200_000, "!" * 200_000, "ab1" * 100_000, "é" * 100_000):
        assert np.array_equal(packing.token_ids(text, VOCABULARY), ids(text))
