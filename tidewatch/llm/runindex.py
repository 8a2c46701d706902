"""Repeated strings of a small collection, from its run-compressed Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


PACKED = 63  # bits of a sort key that carries its position


def sorted_keys(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, keys in order) of keys below 2^bits; equal keys stay in order.

    Where key and position fit into one number, numbers are sorted instead of positions.
    """
    place = len(key).bit_length()
    if bits + place > PACKED:
        order = np.argsort(key, kind="stable")
        return order, key[order]
    both = (key << place) | np.arange(len(key))
    both.sort()
    return both & ((1 << place) - 1), both >> place


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of a text whose separators are all different, by prefix doubling."""
    n = len(text)
    place, wide = n.bit_length(), (int(text.max()) + 1).bit_length()
    step = max(1, (PACKED - place) // wide)  # characters of the first keys
    key = np.zeros(n, np.int64)
    for at in range(step):
        key <<= wide
        key[: max(0, n - at)] += text[at:] + 1
    bits = step * wide
    while True:
        order, key = sorted_keys(key, bits)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        if step >= n or rank[order[-1]] == n - 1:
            return order
        bits = 2 * place
        key = (rank + 1) << place
        key[: n - step] += rank[step:] + 1
        step *= 2


class RunIndex:
    """Runs of the transform, and for each run the suffix at its start and at the end before it.

    The common prefix of neighbours in suffix order has to be measured only where a run
    starts; one sweep through the text then gives it for every suffix, because it shrinks by
    one from a suffix to the next as long as no run starts.
    """

    def __init__(self, text: np.ndarray, longest: int):
        self.text = text
        self.order = suffix_order(text)
        before = text[self.order - 1]
        self.starts = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        self.heads = before[self.starts]
        self.first = self.order[self.starts]  # sampled suffixes: starts of runs
        self.last = self.order[self.starts - 1]  # and ends of the runs before them
        self.common = self._measure(longest)

    def _measure(self, longest: int) -> np.ndarray:
        out = np.zeros(len(self.starts), np.int64)
        padded = np.r_[self.text, np.arange(-longest, 0)]
        live = np.arange(1, len(self.starts))
        for at in range(0, longest, 8):
            a = padded[self.first[live, None] + np.arange(at, at + 8)]
            b = padded[self.last[live, None] + np.arange(at, at + 8)]
            same = np.cumprod(a == b, axis=1).sum(axis=1)
            out[live] += same
            live = live[same == 8]
            if not len(live):
                break
        return out

    def matching_statistics(self) -> np.ndarray:
        """For every suffix, how long a prefix it shares with the one before it in order."""
        reach = np.zeros(len(self.text), np.int64)
        reach[self.first] = self.common + self.first
        return np.maximum(np.maximum.accumulate(reach) - np.arange(len(self.text)), 0)

    def groups(self, length: int) -> np.ndarray:
        """A number for every suffix; those that share ``length`` characters have the same."""
        shared = self.matching_statistics()[self.order]
        out = np.empty(len(self.text), np.int64)
        out[self.order] = np.cumsum(np.r_[False, shared[1:] < length])
        return out

    def earlier(self, place: np.ndarray, length: int) -> np.ndarray:
        """Which suffixes share ``length`` characters with one at a smaller place."""
        shared = self.matching_statistics()[self.order]
        shared[0] = 0
        groups = np.flatnonzero(shared < length)
        least = np.minimum.reduceat(place[self.order], groups)
        sizes = np.diff(np.r_[groups, len(self.order)])
        out = np.zeros(len(self.text), bool)
        out[self.order] = place[self.order] > np.repeat(least, sizes)
        return out
