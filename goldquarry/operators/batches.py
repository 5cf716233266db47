"""Calls on batches that may fail in part."""

from collections.abc import Callable

import pandas as pd


def bisected(call: Callable[[pd.DataFrame], list], batch: pd.DataFrame) -> list[tuple]:
    """(answer, error) for each row of a batch.

    A batch that raises, or answers with another number of rows, is halved until the failing rows are
    alone: k failing rows of n cost about 2 k log2(n / k) + 2 k more calls, and no row that is answered is asked more
    than log2(n) times again.
    """
    try:
        answers = list(call(batch))
        if len(answers) != len(batch):
            raise ValueError(f"{len(answers)} answers to {len(batch)} requests")
        return [(answer, None) for answer in answers]
    except Exception as failure:
        if len(batch) <= 1:
            return [(None, str(failure))] * len(batch)
        half = len(batch) // 2
        return bisected(call, batch.iloc[:half]) + bisected(call, batch.iloc[half:])
