"""Vectorised text helpers for Arrow batches: words, word hashes and rolling hashes.

Texts are read as UTF-8 bytes straight from Arrow buffers, in slices of about a quarter of a megabyte, so the
memory of a task follows the longest text and not the batch.
"""

import ctypes
import functools
import resource
import sys
import types

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18
# Memory above which a worker gives back what it has freed.
WORKER_BYTES = 400 << 20
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
WORD_BASE = U64(0xD6E8FEB86659FD93)


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker."""
    home = sys.modules.setdefault("goldquarry_worker_cache", types.ModuleType("goldquarry_worker_cache"))
    return home.__dict__.setdefault("values", {})


def cached(key, build):
    values = worker_cache()
    if key not in values:
        values[key] = build()
    return values[key]


def released(function):
    """The function, after which a worker that has become large gives the memory that it has freed back to the system.

    Workers live on for later tasks, of other steps too, and keep what their largest task took otherwise.
    """

    @functools.wraps(function)
    def call(table):
        try:
            return function(table)
        finally:
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim and resident_bytes() > WORKER_BYTES:
                pa.default_memory_pool().release_unused()
                trim(0)

    return call


def resident_bytes() -> int:
    """Memory of this process, where the system tells it in /proc."""
    try:
        with open("/proc/self/statm") as sizes:
            return int(sizes.read().split()[1]) * resource.getpagesize()
    except OSError:
        return 0


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (a bijection)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(base: U64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64; kept by the worker for slices of the usual size."""
    size = max(n, SLICE_BYTES + 1)

    def build():
        steps = np.full(size, base, U64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return build()[:n] if size > SLICE_BYTES + 1 else cached(("powers", int(base)), build)[:n]


def _inverse(base: U64) -> U64:
    return U64(pow(int(base), -1, 1 << 64))


class Rolling:
    """Hashes of any substrings of one sequence of numbers, by prefix sums."""

    def __init__(self, values: np.ndarray, base: U64 = BASE):
        n = len(values)
        self.sums = np.zeros(n + 1, U64)
        terms = values.astype(U64)
        terms += U64(1)
        terms *= _powers(base, n)
        np.cumsum(terms, out=self.sums[1:])
        self.shift = _powers(_inverse(base), n + 1)

    def between(self, starts, ends) -> np.ndarray:
        """Hashes of [start, end), the length included."""
        raw = (self.sums[ends] - self.sums[starts]) * self.shift[starts]
        return mix(raw ^ ((ends - starts).astype(U64) * U64(0xA24BAED4963EE407)))

    def windows(self, k: int) -> np.ndarray:
        """Hashes of all windows of k values."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, U64)
        return mix((self.sums[k:] - self.sums[:-k]) * self.shift[: n - k + 1])


def text_slices(column, limit: int = SLICE_BYTES):
    """(first row, bytes, offsets) for runs of texts with about `limit` bytes; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), n)
        part = offsets[row : end + 1]
        yield row, data[part[0] : part[-1]], part - part[0]
        row = end


def byte_table(inside) -> np.ndarray:
    """A boolean table of the bytes that belong to a word."""
    return np.array([bool(inside(b)) for b in range(256)])


# Anything but space and \t \n \v \f \r.
BLANK_SEPARATED = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
# Digits, letters a-z (of lower-cased text) and all bytes of characters beyond ASCII.
LETTERS_AND_DIGITS = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
ASCII_LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """Start and end of each word, and the index of each text's first word (with the total last)."""
    n = len(data)
    inside = table[data]
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    before[offsets] = False  # words end with their text
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(n + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
    """64-bit hashes of the words of lower-cased texts, and the index of each text's first word."""
    lowered = ASCII_LOWER[data]
    starts, ends, first = words(lowered, offsets, table)
    return Rolling(lowered).between(starts, ends), first


def run_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words, runs across texts included: callers leave those out."""
    return Rolling(hashes, WORD_BASE).windows(k)


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of w values."""
    n = len(values) - w + 1
    if n <= 0:
        return values[:0]
    out, have = values, 1
    while have < w:
        step = min(have, w - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def winnowed(hashes: np.ndarray, first: np.ndarray, words: int, grams: int):
    """Of every window of `grams` runs of `words` words within a text, the rightmost smallest one.

    Index of the run's first word, and its hash; texts shorter than a window have none.
    """
    runs = run_hashes(hashes, words)
    n = len(runs) - grams + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    least = sliding_min(runs, grams)
    at = np.zeros(n, np.int64)
    for j in range(grams):
        here = np.flatnonzero(runs[j : j + n] == least)
        at[here] = here + j
    # Windows that begin in one text and end in another don't count.
    across = (first[1:-1, None] - np.arange(1, words + grams - 1)).ravel()
    inside = np.ones(len(hashes) + 1, bool)
    inside[across[across >= 0]] = False
    at = at[inside[:n]]
    at = at[np.append(True, at[1:] != at[:-1])] if len(at) else at
    return at, runs[at]


def ranges(starts, lengths) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one after another."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.repeat(np.asarray(starts, np.int64), lengths) + np.arange(total) - first


def run_ends(first: np.ndarray, total: int) -> np.ndarray:
    """Ends of the runs that begin at `first`; none for no runs."""
    return np.append(first[1:], total)[: len(first)]


def merged(starts: np.ndarray, ends: np.ndarray):
    """Union of half-open intervals, touching ones joined; sorted."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(new)
    return starts[first], ends[np.append(first[1:], len(starts)) - 1]


def signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)
