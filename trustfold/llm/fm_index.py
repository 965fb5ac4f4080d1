"""An FM-index over one shard of word symbols: suffix order, wavelet matrix, backward search, location.

Symbols are small integers.  0 separates runs: no phrase contains it, and
every 0 sorts as a symbol of its own (by position), so suffix comparison
never goes past the end of a run and phrases never match across one.
"""

from __future__ import annotations

import numpy as np

#: Every so many text positions (and at each run's start) the position of the suffix is kept.
SAMPLE = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text`` (prefix doubling; only suffixes that are still tied are sorted again)."""
    n = len(text)
    zeros = text == 0
    rank = text.astype(np.int64) + int(zeros.sum())
    rank[zeros] = np.arange(int(zeros.sum()))
    order = np.argsort(rank, kind="stable")
    sorted_rank = rank[order]
    new = np.concatenate([[True], sorted_rank[1:] != sorted_rank[:-1]])
    place = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # a group's rank is the row it begins at
    rank = np.empty(n, np.int64)
    rank[order] = place
    step = 1
    while True:
        tied = ~(new & np.concatenate([new[1:], [True]]))
        rows = np.flatnonzero(tied)
        if not len(rows):
            return order
        at = order[rows]
        follow = at + step
        second = np.where(follow < n, rank[np.minimum(follow, n - 1)], -1)
        by = np.lexsort((second, place[rows]))
        order[rows] = at[by]
        first, second = place[rows], second[by]
        split = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        new[rows] = split
        place[rows] = np.maximum.accumulate(np.where(split, rows, 0))
        rank[order[rows]] = place[rows]
        step *= 2


class WaveletMatrix:
    """rank(c, i): occurrences of c in the first i symbols, by one counter array for each bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels = bits, []
        s = symbols
        for b in range(bits - 1, -1, -1):
            one = (s >> b) & 1 == 1
            ones = np.zeros(len(s) + 1, np.int32)
            np.cumsum(one, out=ones[1:])
            self.levels.append((ones, len(s) - int(ones[-1])))
            s = np.concatenate([s[~one], s[one]])
        # where each symbol's block begins after the last level
        self.first = {}
        values, starts = np.unique(s, return_index=True)
        self.begin = np.zeros(1 << bits, np.int64)
        self.begin[values] = starts

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        i = i.astype(np.int64)
        for level, (ones, zeros) in enumerate(self.levels):
            one = (c >> (self.bits - 1 - level)) & 1 == 1
            before = ones[i].astype(np.int64)
            i = np.where(one, zeros + before, i - before)
        return i - self.begin[c]


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        """Index ``text`` (values 0..symbols-1)."""
        order = suffix_order(text)
        bwt = text[order - 1]  # the suffix at 0 takes the last symbol, which is a separator
        self.bwt = bwt
        self.wavelet = WaveletMatrix(bwt, max(1, int(symbols - 1).bit_length()))
        self.count = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        after_gap = np.concatenate([[True], text[:-1] == 0])
        self.kept = (order % SAMPLE == 0) | after_gap[order]
        self.where = np.where(self.kept, order, -1)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase (rows of symbols, 0 behind the end)."""
        n = len(phrases)
        low, high = np.zeros(n, np.int64), np.full(n, len(self.bwt), np.int64)
        alive = np.arange(n)
        for back in range(int(lengths.max()) if n else 0):
            alive = alive[(high[alive] > low[alive])]
            now = alive[lengths[alive] > back]
            if not len(now):
                break
            c = phrases[now, lengths[now] - 1 - back]
            low[now] = self.count[c] + self.wavelet.rank(c, low[now])
            high[now] = self.count[c] + self.wavelet.rank(c, high[now])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk backwards to a sampled one."""
        rows, out = rows.astype(np.int64), np.full(len(rows), -1, np.int64)
        todo, steps = np.arange(len(rows)), 0
        while len(todo):
            known = self.kept[rows[todo]]
            done = todo[known]
            out[done] = self.where[rows[done]] + steps
            todo = todo[~known]
            c = self.bwt[rows[todo]]
            rows[todo] = self.count[c] + self.wavelet.rank(c, rows[todo])
            steps += 1
        return out
