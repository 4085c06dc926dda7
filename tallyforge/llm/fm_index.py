"""An FM-index over one shard of word ids, in numpy, searched in batches.

The text is a sequence of small integers; 0 separates segments and is never
part of a phrase.  The transform's symbol counts come from a wavelet matrix;
positions are sampled every eighth symbol and at each segment's start, so a
walk to a sample never crosses a separator.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array; separators sort first, by position, each unlike any
    other, so ties end within a segment.  Prefix doubling of tied suffixes."""
    zeros = np.flatnonzero(text == 0)
    key = text.astype(np.int64) + len(zeros)
    key[zeros] = np.arange(len(zeros))
    order = np.argsort(key, kind="stable")
    place, group = np.arange(len(text)), np.empty(len(text), np.int64)
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    group[order] = np.maximum.accumulate(np.where(new, place, 0))
    h = 1
    while True:
        alone = new & np.concatenate((new[1:], [True]))
        tied = np.flatnonzero(~alone)
        if not len(tied):
            return order
        at = order[tied]
        pair = group[at] * len(text) + group[at + h]
        by = np.argsort(pair, kind="stable")
        order[tied], pair = at[by], pair[by]
        new[tied] = np.concatenate(([True], pair[1:] != pair[:-1]))
        group[order[tied]] = np.maximum.accumulate(np.where(new[tied], tied, 0))
        h *= 2


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        order = suffix_order(text)
        self.n = len(text)
        bwt = text[order - 1]
        self.bwt = bwt
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols + 1))))
        sampled = (order % SAMPLE == 0) | (bwt == 0)
        self.sample = np.where(sampled, order, -1)
        self.levels = []
        for bit in reversed(range(max(1, int(symbols).bit_length()))):
            b = (bwt >> bit) & 1
            ones = np.concatenate(([0], np.cumsum(b))).astype(np.int32)
            self.levels.append((bit, ones, self.n - int(ones[-1])))
            bwt = np.concatenate((bwt[b == 0], bwt[b == 1]))

    def rank(self, c: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How often c occurs in the transform before ``end``."""
        start = np.zeros_like(end)
        for bit, ones, zeros in self.levels:
            s, e = ones[start], ones[end]
            up = (c >> bit) & 1 == 1
            start, end = np.where(up, zeros + s, start - s), np.where(up, zeros + e, end - e)
        return end - start

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows [lo, hi) of every phrase that occurs: (phrase, lo, hi).
        ``phrases`` has one row each, padded on the right."""
        who = np.arange(len(sizes))
        lo, hi = np.zeros(len(who), np.int64), np.full(len(who), self.n)
        out = []
        for step in range(1, int(sizes.max(initial=0)) + 1):
            c = phrases[who, sizes[who] - step]
            lo, hi = self.less[c] + self.rank(c, lo), self.less[c] + self.rank(c, hi)
            live = lo < hi
            done = live & (sizes[who] == step)
            out.append((who[done], lo[done], hi[done]))
            live &= ~done
            who, lo, hi = who[live], lo[live], hi[live]
            if not len(who):
                break
        return tuple(np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the given rows."""
        at, steps, todo = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(todo := todo[self.sample[at[todo]] < 0]):
            c = self.bwt[at[todo]]
            at[todo] = self.less[c] + self.rank(c, at[todo])
            steps[todo] += 1
        return self.sample[at] + steps
