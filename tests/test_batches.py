"""Failing rows of a batch, found by halving."""

from math import log2

import pandas as pd
import pytest

from goldquarry.operators.augment import _statuses
from goldquarry.operators.batches import bisected
from goldquarry.operators.inference import _answers


class Caller:
    def __init__(self, bad, short=()):
        self.bad, self.short, self.calls, self.rows = set(bad), set(short), 0, 0

    def __call__(self, batch):
        self.calls += 1
        self.rows += len(batch)
        if self.bad & set(batch["id"]):
            raise ValueError(f"no answer to {sorted(self.bad & set(batch['id']))[0]}")
        return [f"a{i}" for i in batch["id"] if i not in self.short]


@pytest.mark.parametrize("n,bad", [(1000, []), (1000, [7]), (1000, [0, 500, 999]), (5, [0, 1, 2, 3, 4]), (0, []), (1, [0])])
def test_each_row_has_its_answer(n, bad):
    caller = Caller(bad)
    batch = pd.DataFrame({"id": range(n)}, index=range(100, 100 + n))
    got = _answers(caller, batch)
    assert list(got.index) == list(batch.index) and len(got) == n
    for i, (text, error) in zip(range(n), got[["raw_text", "error"]].itertuples(index=False)):
        assert (text, error) == ((None, f"no answer to {i}") if i in bad else (f"a{i}", None))
    if n > 1:
        assert caller.calls <= 1 + 2 * len(bad) * (log2(n) + 1)
        assert caller.rows <= n * (1 + len(bad) * (log2(n) + 1))


def test_one_bad_row_costs_log_n_calls():
    caller = Caller([613])
    bisected(caller, pd.DataFrame({"id": range(4096)}))
    assert caller.calls == 1 + 2 * 12


def test_missing_answers_and_statuses():
    assert [e is None for _, e in bisected(Caller([], short=[2]), pd.DataFrame({"id": range(4)}))] == [True, True, False, True]
    assert _statuses(Caller([1]), pd.DataFrame({"id": range(3)})) == ["a0", "failed: no answer to 1", "a2"]
