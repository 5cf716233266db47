"""Periodic runs: stretches of words that repeat themselves.

A run is a stretch of consecutive words with smallest period q, at least max(6, 4q) long, that no
neighbouring word extends. Each of its words occurs four times in it or more. So words that occur
too rarely within a segment split it, which makes other words rare in the parts; this is repeated
until nothing changes. What survives is scanned lag by lag: of a run of period q, two whole blocks
of q words that begin at a multiple of q are equal, so blocks are compared by their hashes at those
places only, n / q for a lag, and equal ones are extended by binary search.

Words are compared by 64-bit hashes.
"""

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from goldquarry.llm.common import small_batches
from goldquarry.llm.kernels import BLANK_SEPARATED, WORD_BASE, Rolling, ranges, text_slices, words

LEAST_WORDS, LEAST_PERIODS = 6, 4
# Blocks compared at a time.
BLOCKS_AT_ONCE = 1 << 20
# Splitting ends when a round removes less than this share of the words that are left; what is left
# over costs time in the scan, and changes no result.
LEAST_PROGRESS = 1 / 64

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))


def surviving_segments(ids: np.ndarray, first: np.ndarray):
    """Starts and ends of the segments in which every word may be part of a run.

    `ids` are the words of all texts, text t having first[t] .. first[t + 1].
    """
    at = np.arange(len(ids))
    segment = np.repeat(np.arange(len(first) - 1), np.diff(first))
    starts, ends = [], []
    while len(at):
        _, word, count = np.unique(segment * (int(ids.max()) + 1) + ids[at], return_inverse=True, return_counts=True)
        rare = count[word] < LEAST_PERIODS
        changed = np.zeros(int(segment[-1]) + 1, bool)
        changed[segment[rare]] = True
        slow = rare.sum() < LEAST_PROGRESS * len(at)
        done = ~changed[segment] | (slow & ~rare)
        for kept, finished in ((done, True), (~done & ~rare, False)):
            here, of = at[kept], segment[kept]
            new = np.ones(len(here) + 1, bool)
            new[1:-1] = (np.diff(here) > 1) | (np.diff(of) > 0)
            cuts = np.flatnonzero(new)
            sizes = np.diff(cuts)
            long = sizes >= LEAST_WORDS
            if finished:
                starts.append(here[cuts[:-1][long]])
                ends.append(starts[-1] + sizes[long])
            else:
                inside = np.repeat(long, sizes)
                at, segment = here[inside], np.repeat(np.arange(len(sizes)), sizes)[inside]
        if slow:
            break
    starts, ends = np.concatenate([*starts, np.zeros(0, int)]), np.concatenate([*ends, np.zeros(0, int)])
    order = np.argsort(starts)
    return starts[order], ends[order]


def _extended(hashes: Rolling, left: np.ndarray, right: np.ndarray, room: np.ndarray, forward: bool) -> np.ndarray:
    """How far the words from `left` on (or before it) equal those from `right` on (or before it), at most `room`."""
    have, step = np.zeros(len(left), np.int64), 1 << int(room.max(initial=0)).bit_length()
    while step:
        longer = have + step
        fits = longer <= room
        n = np.where(fits, longer, 0)
        a, b = (left, right) if forward else (left - n, right - n)
        same = hashes.between(a, a + n) == hashes.between(b, b + n)
        have = np.where(fits & same, longer, have)
        step //= 2
    return have


def runs_in(hashes: Rolling, starts: np.ndarray, ends: np.ndarray):
    """All runs of the segments: (start, length, period), sorted by start and period."""
    lags = (ends - starts) // LEAST_PERIODS
    segment = np.repeat(np.arange(len(starts)), lags)
    lag = ranges(np.ones(len(starts), np.int64), lags)
    blocks = (ends - starts)[segment] // lag - 1  # pairs of neighbouring blocks
    found = []
    upto = np.cumsum(blocks)
    row = 0
    while row < len(lag):
        stop = max(row + 1, int(np.searchsorted(upto, upto[row] + BLOCKS_AT_ONCE)))
        n = blocks[row:stop]
        of = np.repeat(np.arange(row, stop), n)
        a = starts[segment[of]] + ranges(np.zeros(len(n), np.int64), n) * lag[of]
        q = lag[of]
        same = hashes.between(a, a + q) == hashes.between(a + q, a + 2 * q)
        # Neighbouring pairs of one lag lie in one run.
        new = same.copy()
        new[1:] &= ~(same[:-1] & (of[1:] == of[:-1]))
        a, q, of = a[new], q[new], segment[of[new]]
        before = _extended(hashes, a, a + q, a - starts[of], False)
        after = _extended(hashes, a, a + q, ends[of] - a - q, True)
        run = np.stack([a - before, before + after + q, q], 1)
        found.append(run[run[:, 1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)])
        row = stop
    found = np.unique(np.concatenate([*found, np.zeros((0, 3), np.int64)]), axis=0)
    # A multiple of a period covers the same stretch, which is listed by its smallest one.
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(1)
    found = found[first]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def repeated_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words some run holds behind its first period."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(steps)[:n] > 0


def find_runs(docs: DataFrame, doc="doc_id", text="text", keep_text=True) -> DataFrame:
    """Per row: doc_id, n_words, runs (start, length, period; by start, then period), n_dropped and collapsed.

    Words are maximal stretches without ASCII white space, numbered from 0. collapsed is the text
    without the words that a run repeats (those behind its first period), one space between words; it is left out without
    keep_text. Null and empty texts have no words, no runs and an empty collapsed text; repeated rows
    each get a row; other columns are ignored. Texts are read in whole, in one pass without a shuffle; a text of n words
    takes about n log n steps, whatever its words.
    """
    small_batches(docs.sparkSession)

    def find(batches):
        for batch in batches:
            for row, data, offsets in text_slices(batch.column("text")):
                n = len(offsets) - 1
                word_start, word_end, first = words(data, offsets, BLANK_SEPARATED)
                hashed = Rolling(data).between(word_start, word_end)
                ids = np.unique(hashed, return_inverse=True)[1]
                found = runs_in(Rolling(hashed, WORD_BASE), *surviving_segments(ids, first))
                of = np.searchsorted(first, found[:, 0], "right") - 1
                kept = ~repeated_words(len(hashed), found)
                found[:, 0] -= first[of]
                values = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(3)], fields=list(RUN))
                dropped = np.concatenate([[0], np.cumsum(~kept)])
                columns = {
                    "doc_id": batch.column("doc_id").slice(row, n),
                    "n_words": pa.array(np.diff(first)),
                    "runs": pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32()), values),
                    "n_dropped": pa.array(np.diff(dropped[first])),
                }
                if keep_text:
                    texts = []
                    for t in range(n):
                        parts = data[offsets[t] : offsets[t + 1]].tobytes().split()
                        texts.append(b" ".join(compress(parts, kept[first[t] : first[t + 1]].tolist())).decode())
                    columns["collapsed"] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType().add("doc_id", "long").add("n_words", "long").add("runs", RUNS).add("n_dropped", "long")
    return rows.mapInArrow(find, schema.add("collapsed", "string") if keep_text else schema)
