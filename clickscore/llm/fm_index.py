"""An FM-index of integer symbols: suffix order, wavelet-matrix ranks, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    step = 1
    while n and step < 2 * n:
        second = np.zeros(n, np.int64)
        second[: max(n - step, 0)] = rank[step:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank = new
        if rank[order[-1]] == n - 1:
            break
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of many symbols at many places at once."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = max(1, int(top).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        now = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            self.ones.append(np.concatenate(([0], np.cumsum(bit))).astype(np.int32))
            self.zeros.append(int(len(now) - self.ones[-1][-1]))
            now = np.concatenate((now[bit == 0], now[bit == 1]))

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        low = np.zeros(len(symbol), np.int64)
        high = upto.astype(np.int64)
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            bit = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            ones_low, ones_high = ones[low], ones[high]
            low = np.where(bit, zeros + ones_low, low - ones_low)
            high = np.where(bit, zeros + ones_high, high - ones_high)
        return high - low


class FmIndex:
    """Index of a shard's symbols (1 and above; a 0 closes each stretch of text).

    The starts of stretches are sampled too, so stepping back never passes a 0.
    """

    def __init__(self, text: np.ndarray, top: int):
        order = suffix_array(text)
        self.size = len(text)
        self.last = text[order - 1]  # the symbol before each suffix, in suffix order
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=top + 1))))
        self.tree = WaveletMatrix(self.last, top)
        sampled = (order % SAMPLE == 0) | (self.last == 0)
        self.is_sampled = sampled
        self.sample_rank = np.concatenate(([0], np.cumsum(sampled)))
        self.samples = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals of patterns, each right-aligned in its row."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), self.size, np.int64)
        width = patterns.shape[1]
        for back in range(width):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, width - 1 - back]
            base = self.less[symbol]
            low[live], high[live] = (
                base + self.tree.rank(symbol, low[live]),
                base + self.tree.rank(symbol, high[live]),
            )
        return low, np.maximum(low, high)

    def locate(self, places: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: step back until a sampled one is met."""
        at = places.copy()
        steps = np.zeros(len(at), np.int64)
        found = np.full(len(at), -1, np.int64)
        live = np.arange(len(at))
        while len(live):
            done = self.is_sampled[at[live]]
            hit = live[done]
            found[hit] = self.samples[self.sample_rank[at[hit]]] + steps[hit]
            live = live[~done]
            symbol = self.last[at[live]]
            at[live] = self.less[symbol] + self.tree.rank(symbol, at[live])
            steps[live] += 1
        return found
