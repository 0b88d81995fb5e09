"""A compressed FM-index over sequences of numbered words, searched backward in lockstep."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit vector per bit of a symbol, with counts every 64 positions."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        self.n = len(seq)
        self.levels = max(1, int(sigma - 1).bit_length())
        self.bits: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.levels - 1, -1, -1):
            bit = ((seq >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, 16 - len(packed) % 8)).view(np.uint64)
            self.bits.append(packed)
            self.counts.append(np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.uint32)].astype(np.uint32))
            self.zeros.append(int(self.n - bit.sum()))
            seq = np.concatenate([seq[~bit], seq[bit]])

    def follow(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position ``at`` ends up when sorted down to each symbol; ``at`` has the shape of symbols or rows of it."""
        for k, (bits, counts, zeros) in enumerate(zip(self.bits, self.counts, self.zeros)):
            one = (symbols >> (self.levels - 1 - k)) & 1 == 1
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            ones = counts[word] + np.bitwise_count(bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            at = np.where(one, zeros + ones, at - ones)
        return at


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    k = 1
    while True:
        second = np.zeros(n, np.int64)
        second[: n - k] = rank[k:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            return order
        k *= 2


class FMIndex:
    """Backward search over several sequences of words numbered from 1; no match crosses their ends."""

    def __init__(self, sequences: list[np.ndarray], sigma: int) -> None:
        ends = np.cumsum([len(s) + 1 for s in sequences])
        n, m = int(ends[-1]), len(sequences)
        self.text = np.zeros(n, np.int64)
        keys = np.empty(n, np.int64)
        at = 0
        for i, s in enumerate(sequences):
            self.text[at : at + len(s)] = s
            keys[at : at + len(s)] = s + m
            keys[at + len(s)] = i  # ends are all different, so suffixes differ within their sequence
            at += len(s) + 1
        order = suffix_array(keys)
        last = self.text[order - 1]
        self.first = np.r_[0, np.cumsum(np.bincount(self.text, minlength=sigma))].astype(np.int64)
        self.ranks = WaveletMatrix(last, sigma)
        symbols = np.arange(sigma)
        self.base = self.ranks.follow(symbols, np.zeros(sigma, np.int64))
        self.n = n

    def extend(self, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals after one more word to the left."""
        both = self.ranks.follow(words, np.stack([low, high]))
        shift = self.first[words] - self.base[words]
        return both[0] + shift, both[1] + shift

    def repeated_from(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """For text positions begin < end: the smallest x >= begin such that the words x..end-1 occur twice or more."""
        at = end.copy()
        low, high = np.zeros(len(end), np.int64), np.full(len(end), self.n, np.int64)
        active = np.arange(len(end))
        while len(active):
            low[active], high[active] = self.extend(self.text[at[active] - 1], low[active], high[active])
            active = active[high[active] - low[active] >= 2]
            at[active] -= 1
            active = active[at[active] > begin[active]]
        return at


def repeated_windows(sequences: list[np.ndarray], weights: list[int], sigma: int, width: int) -> list[list[tuple[int, int]]]:
    """For each sequence, spans [a, b) covered by windows of ``width`` words that occur twice or more.

    A sequence of weight 2 or more is indexed twice. Matching statistics decide ranges of windows at once: searching back from
    the end of a range's middle window either reaches the range's start (all of them repeat) or stops at
    x: windows from x on repeat if there are any, else all that hold the stretch from x-1 are unique.
    """
    indexed, starts, at = [], [], 0
    for s, w in zip(sequences, weights):
        starts.append(at)
        for _ in range(min(w, 2)):
            indexed.append(s)
            at += len(s) + 1
    index = FMIndex(indexed, sigma)
    base = np.array(starts, np.int64)
    owner = np.array([i for i, s in enumerate(sequences) if len(s) >= width], np.int64)
    first = np.zeros(len(owner), np.int64)
    last = np.array([len(sequences[i]) - width for i in owner], np.int64)
    middle = last.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(owner):
        x = index.repeated_from(base[owner] + first, base[owner] + middle + width) - base[owner]
        hit = x <= middle
        found.append((owner[hit], np.maximum(x, first)[hit], middle[hit]))
        # Left of the middle: before x if windows from x on repeat, else before the middle.
        left_last = np.where(hit, x - 1, middle - 1)
        # Right of it: windows after the middle, but those that start before x hold a unique stretch.
        right_first = np.where(hit, middle + 1, np.minimum(x, last + 1))
        owner = np.concatenate([owner, owner])
        first, last = np.concatenate([first, right_first]), np.concatenate([left_last, last])
        some = first <= last
        owner, first, last = owner[some], first[some], last[some]
        middle = (first + last) // 2
    spans: list[list[tuple[int, int]]] = [[] for _ in sequences]
    for o, a, b in found:
        for i, lo, hi in zip(o.tolist(), a.tolist(), b.tolist()):
            spans[i].append((lo, hi + width))
    return [merged(s) for s in spans]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
