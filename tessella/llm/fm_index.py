"""An FM-index over words: suffix array, wavelet-matrix ranks, backward search and sampled locate, all in arrays."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_order(s: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only groups that are still tied are sorted again. The last symbol and every
    symbol that may be followed by the end must be unique, so that ties break before the text ends."""
    n = len(s)
    at = np.arange(n)
    sa = np.argsort(s, kind="stable")
    head = np.ones(n, bool)
    head[1:] = s[sa[1:]] != s[sa[:-1]]
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(head, at, 0))
    k = 1
    while True:
        single = head.copy()
        single[:-1] &= head[1:]
        act = np.flatnonzero(~single)
        if not act.size:
            return sa
        suf = sa[act]
        group, nxt = rank[suf], rank[suf + k]
        order = np.lexsort((nxt, group))
        suf, group, nxt = suf[order], group[order], nxt[order]
        fresh = np.ones(len(act), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (nxt[1:] != nxt[:-1])
        sa[act] = suf
        head[act] = fresh
        rank[suf] = act[np.maximum.accumulate(np.where(fresh, np.arange(len(act)), 0))]
        k *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector with running zero counts per bit of the alphabet."""

    def __init__(self, s: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (s >> bit & 1).astype(bool)
            zeros = np.zeros(len(s) + 1, np.int32)
            np.cumsum(~ones, out=zeros[1:])
            self.levels.append((bit, zeros))
            s = np.concatenate([s[~ones], s[ones]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` occurs before position ``i``, for aligned arrays."""
        start = np.zeros(len(i), np.int64)
        for bit, zeros in self.levels:
            one = (c >> bit & 1).astype(bool)
            z_i, z_s, total = zeros[i], zeros[start], zeros[-1]
            i = np.where(one, total + i - z_i, z_i)
            start = np.where(one, total + start - z_s, z_s)
        return i - start


class FMIndex:
    """Index of a text of words 1..top in which 0 separates runs; phrases never cross a separator.

    Separators are ordered by their place, below all words, so they are unique and every suffix comparison ends
    at one. Suffix positions are sampled at every ``SAMPLE``-th word and at the first word of each run.
    """

    def __init__(self, text: np.ndarray, top: int):
        text = np.append(text, 0) if not len(text) or text[-1] else text
        sep = np.flatnonzero(text == 0)
        symbols = text.astype(np.int64) + len(sep)
        symbols[sep] = np.arange(len(sep))
        sa = suffix_order(symbols)
        self.bwt = text[sa - 1]  # the text ends with a separator, so sa = 0 gets 0
        counts = np.bincount(text, minlength=top + 1)
        self.first = np.cumsum(counts) - counts
        self.count = counts
        self.wavelet = WaveletMatrix(self.bwt, top)
        sampled = (sa % SAMPLE == 0) | (self.bwt == 0)
        self.sample_at = np.cumsum(sampled) - 1
        self.sampled = sampled
        self.samples = sa[sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of phrases (rows of words, left-aligned), by backward search from each last word."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), len(self.bwt), np.int64)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > step) & (lo < hi))
            if not live.size:
                break
            c = phrases[live, lengths[live] - 1 - step]
            lo[live] = self.first[c] + self.wavelet.rank(c, lo[live])
            hi[live] = self.first[c] + self.wavelet.rank(c, hi[live])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk to the word before until a sampled one."""
        out = np.empty(len(rows), np.int64)
        todo, row, steps = np.arange(len(rows)), rows, 0
        while todo.size:
            done = self.sampled[row]
            out[todo[done]] = self.samples[self.sample_at[row[done]]] + steps
            todo, row = todo[~done], row[~done]
            c = self.bwt[row]
            row = self.first[c] + self.wavelet.rank(c, row)
            steps += 1
        return out
