"""FM-index over a sequence of small numbers: suffix array by prefix doubling, wavelet matrix, sampled positions."""

from __future__ import annotations

import numpy as np

from .arrow import ragged_take

#: Every so many positions of the sequence are kept with the index.
SAMPLE = 16


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Start of each suffix in ascending order. 0 separates: zeros are smaller than all else and differ from each other
    by their place, so that no comparison goes past one. The last number must be 0."""
    n = len(seq)
    if not n:
        return np.zeros(0, dtype=np.int64)
    zeros = np.flatnonzero(seq == 0)
    rank = seq.astype(np.int64) + len(zeros) - 1
    rank[zeros] = np.arange(len(zeros))
    # first order: several numbers and the position packed into one integer
    width, place = max(1, int(rank.max()).bit_length()), max(1, (n - 1).bit_length())
    fit = max(1, (63 - place) // width)
    key = rank.copy()
    for k in range(1, fit):
        key <<= width
        key[:-k] |= rank[k:]
    packed = np.sort((key << place) | np.arange(n)) if fit * width + place <= 63 else None
    if packed is None:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
    else:
        order = packed & ((1 << place) - 1)
        ordered = packed >> place
    first = np.append(True, ordered[1:] != ordered[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0))  # rank of a group: the place of its first member
    rank = np.empty(n, dtype=np.int64)
    rank[order] = head
    length = fit
    alone = first & np.append(first[1:], True)
    open_ = np.flatnonzero(~alone)  # places in the order that are still tied with others
    while len(open_):
        suffix = order[open_]
        group = head[open_]
        after = np.minimum(suffix + length, n - 1)
        sort = np.lexsort((rank[after], group))
        suffix, follow = suffix[sort], rank[after][sort]
        order[open_] = suffix
        new = np.append(True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1]))
        start = np.maximum.accumulate(np.where(new, open_, 0))
        head[open_] = start
        rank[suffix] = start
        length *= 2
        open_ = open_[~(new & np.append(new[1:], True))]
    return order


class Wavelet:
    """Wavelet matrix: how often a number occurs before a place, and which number is there, for many places at once."""

    def __init__(self, seq: np.ndarray, bits: int):
        self.bits, self.n = bits, len(seq)
        self.words, self.before, self.zeros = [], [], []
        now = seq
        for level in range(bits - 1, -1, -1):
            one = (now >> level) & 1 == 1
            packed = np.packbits(np.append(one, np.zeros(-len(one) % 64 + 64, dtype=bool)), bitorder="little").view("<u8")
            count = np.zeros(len(packed) + 1, dtype=np.int64)
            np.cumsum(np.bitwise_count(packed), out=count[1:])
            self.words.append(packed)
            self.before.append(count)
            self.zeros.append(len(one) - int(count[-1]))
            now = np.concatenate([now[~one], now[one]])

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        inside = self.words[level][word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[level][word] + np.bitwise_count(inside)

    def rank(self, number: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``number[i]`` before place ``at[i]``."""
        low, high = np.zeros(len(at), dtype=np.int64), at.astype(np.int64)
        for level in range(self.bits):
            one = (number >> (self.bits - 1 - level)) & 1 == 1
            a, b = self._ones(level, low), self._ones(level, high)
            low = np.where(one, self.zeros[level] + a, low - a)
            high = np.where(one, self.zeros[level] + b, high - b)
        return high - low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The number at each place."""
        out, now = np.zeros(len(at), dtype=np.int64), at.astype(np.int64)
        for level in range(self.bits):
            one = (self.words[level][now >> 6] >> (now & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones = self._ones(level, now)
            now = np.where(one, self.zeros[level] + ones, now - ones)
            out = (out << 1) | one
        return out


class FMIndex:
    """Index of one shard's sequence of numbers below ``size``; 0 separates and can't be searched for."""

    def __init__(self, seq: np.ndarray, size: int, sample: int = SAMPLE):
        order = suffix_array(seq)
        last = np.where(order > 0, seq[order - 1], 0)
        self.n = len(seq)
        self.first = np.zeros(size + 1, dtype=np.int64)
        np.cumsum(np.bincount(seq, minlength=size), out=self.first[1:])
        self.tree = Wavelet(last.astype(np.int64), max(1, (size - 1).bit_length()))
        # kept: every sample-th position, and all that follow a separator, so that no walk has to cross one
        kept = (order % sample == 0) | (last == 0)
        self.kept_at = np.flatnonzero(kept)
        self.kept_bits = kept
        self.kept_before = np.zeros(self.n + 1, dtype=np.int64)
        np.cumsum(kept, out=self.kept_before[1:])
        self.kept = order[kept]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of suffixes that begin with each pattern (a row of numbers from 1, padded at its end)."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for back in range(int(lengths.max()) if len(lengths) else 0):
            live = np.flatnonzero((lengths > back) & (high > low))
            if not len(live):
                continue
            number = patterns[live, lengths[live] - 1 - back]
            low[live] = self.first[number] + self.tree.rank(number, low[live])
            high[live] = self.first[number] + self.tree.rank(number, high[live])
        return low, np.maximum(low, high)

    def locate(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Position of every occurrence, and the pattern that it belongs to."""
        count = high - low
        at = ragged_take(low, count)
        which = np.repeat(np.arange(len(low)), count)
        out = np.zeros(len(at), dtype=np.int64)
        left, steps = np.arange(len(at)), 0
        while len(left):
            here = self.kept_bits[at[left]]
            done = left[here]
            out[done] = self.kept[self.kept_before[at[done]]] + steps
            left = left[~here]
            number = self.tree.access(at[left])
            at[left] = self.first[number] + self.tree.rank(number, at[left])
            steps += 1
        return out, which
