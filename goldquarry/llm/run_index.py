"""A run-compressed Burrows-Wheeler index with sampled run ends, and matching statistics over it.

Symbols are integers. Every string of the indexed collection ends with a symbol of its own, smaller
than all others, so suffixes never agree beyond a string's end. Patterns are streamed from right to
left, all at once: a pattern keeps a row of the transform and the text position of that row. Where
the row's run has the wanted symbol, the row moves by the LF mapping and the position by one; else
the row jumps to the nearer end, by common prefix, of the runs of that symbol before and after, and
the position is the sample stored there. The position is then one of a longest match of the rest of
the pattern.
"""

import numpy as np


def ragged(values: np.ndarray, lengths: np.ndarray, fill: int) -> np.ndarray:
    """Rows of different lengths as a matrix, filled up at the right."""
    out = np.full((len(lengths), int(lengths.max(initial=0))), fill, np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


class RunIndex:
    def __init__(self, values: np.ndarray, lengths: np.ndarray):
        """Index strings given one after another; symbols are not negative."""
        strings = len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        self.text = np.empty(len(values) + strings, np.int64)
        inside = np.ones(len(self.text), bool)
        inside[ends] = False
        self.text[inside] = values + strings
        self.text[ends] = np.arange(strings)
        self.offset = strings
        self._sort()
        self._compress()

    def _sort(self) -> None:
        n = len(self.text)
        rank = np.unique(self.text, return_inverse=True)[1].astype(np.int64)
        self.ranks, step = [rank], 1
        while True:
            second = np.zeros(n, np.int64)
            second[:-step] = rank[step:] + 1
            key = rank * (n + 1) + second
            order = np.argsort(key)
            ordered = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.append(0, np.cumsum(ordered[1:] != ordered[:-1]))
            rank, step = new, 2 * step
            if step >= n or rank[order[-1]] == n - 1:
                break
            self.ranks.append(rank)
        self.suffixes = order

    def _compress(self) -> None:
        last = self.text[self.suffixes - 1]  # the text's first symbol is preceded by its last
        self.starts = np.flatnonzero(np.append(True, last[1:] != last[:-1]))
        self.symbols = last[self.starts]
        lengths = np.diff(np.append(self.starts, len(last)))
        # Samples: text positions of the first and the last row of each run.
        self.first_sample = self.suffixes[self.starts]
        self.last_sample = self.suffixes[self.starts + lengths - 1]
        self.lengths = lengths
        # Runs by symbol, and for each run the row that its first row is mapped to.
        self.by_symbol = np.argsort(self.symbols, kind="stable")
        self.keys = self.symbols[self.by_symbol] * len(self.starts) + self.by_symbol
        self.mapped = np.empty(len(lengths), np.int64)
        self.mapped[self.by_symbol] = np.cumsum(lengths[self.by_symbol]) - lengths[self.by_symbol]
        self._common_prefixes()

    def _common_prefixes(self) -> None:
        """Longest common prefixes of neighbouring rows, and their minima over powers of two."""
        a, b = self.suffixes[:-1], self.suffixes[1:]
        length, n = np.zeros(len(a), np.int64), len(self.text)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            x, y = a + length, b + length
            same = (x < n) & (y < n)
            same &= rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)]
            length += same << k
        minima = [np.append(0, length).astype(np.int32)]
        while 2 * len(minima[0]) > 2 << len(minima) and len(minima[-1]) > 1 << (len(minima) - 1):
            half = 1 << (len(minima) - 1)
            minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
        self.minima = minima

    def _common(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Common prefix of the suffixes of two rows, low < high."""
        width = high - low
        level = np.frexp(width.astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int32)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            row = self.minima[k]
            out[at] = np.minimum(row[low[at] + 1], row[high[at] + 1 - (1 << k)])
        return out

    def positions(self, patterns: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Text position of a longest match of each pattern's rest from every place on; -1 if its symbol never occurs."""
        count, width = patterns.shape
        out = np.full((count, width), -1, np.int64)
        row = np.zeros(count, np.int64)
        place = np.full(count, self.suffixes[0], np.int64)
        runs = len(self.starts)
        for at in range(width - 1, -1, -1):
            now = np.flatnonzero(lengths > at)
            symbol = patterns[now, at] + self.offset
            run = np.searchsorted(self.starts, row[now], "right") - 1
            after = np.searchsorted(self.keys, symbol * runs + run)
            same = self.symbols[run] == symbol
            before = after - 1
            has_before = (before >= 0) & (self.symbols[self.by_symbol[np.maximum(before, 0)]] == symbol)
            has_after = (after < runs) & (self.symbols[self.by_symbol[np.minimum(after, runs - 1)]] == symbol)
            jump = ~same & (has_before | has_after)
            up = self.by_symbol[np.maximum(before, 0)]
            down = self.by_symbol[np.minimum(after, runs - 1)]
            up_row, down_row = self.starts[up] + self.lengths[up] - 1, self.starts[down]
            use_up = has_before & ~has_after
            both = np.flatnonzero(jump & has_before & has_after)
            if len(both):
                here = row[now[both]]
                use_up[both] = self._common(up_row[both], here) >= self._common(here, down_row[both])
            target = np.where(use_up, up, down)
            run = np.where(same, run, target)
            from_row = np.where(same, row[now], np.where(use_up, up_row, down_row))
            from_place = np.where(same, place[now], np.where(use_up, self.last_sample[up], self.first_sample[down]))
            found = same | jump
            row[now] = np.where(found, self.mapped[run] + from_row - self.starts[run], row[now])
            place[now] = np.where(found, from_place - 1, place[now])
            out[now, at] = np.where(found, from_place - 1, -1)
        return out

    def has_windows(self, patterns: np.ndarray, lengths: np.ndarray, k: int) -> np.ndarray:
        """Whether each window of k symbols of a pattern occurs in the collection."""
        count, width = patterns.shape
        if width < k:
            return np.zeros((count, 0), bool)
        places = self.positions(patterns, lengths)[:, : width - k + 1]
        there = (places >= 0) & (places + k <= len(self.text)) & (np.arange(width - k + 1) + k <= lengths[:, None])
        pattern, at = np.nonzero(there)
        text, start = self.text, places[pattern, at]
        for j in range(k):
            same = text[start + j] == patterns[pattern, at + j] + self.offset
            pattern, at, start = pattern[same], at[same], start[same]
        out = np.zeros_like(there)
        out[pattern, at] = True
        return out
