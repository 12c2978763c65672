"""Suffix arrays over bytes in numpy: Larsson and Sadakane's refinement, Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

LANES = 1 << 14  # positions that Kasai's recurrence follows side by side


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, the first one lowest; zeros behind the end."""
    words = np.zeros(len(data) + 8, np.uint64)
    words[: len(data)] = data
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        words[:-step] |= words[step:] << np.uint64(bits)
    return words[: len(data)]


def suffix_order(data: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of ``data`` in order.

    Suffixes are sorted by eight bytes first. Then, as long as some agree on the ``done`` bytes looked
    at, those alone are sorted again by the rank of what follows these bytes, which doubles them.
    """
    n = len(data)
    key = words_at(data).byteswap()
    order = np.argsort(key)
    key = key[order]
    fresh = np.ones(n, bool)
    fresh[1:] = key[1:] != key[:-1]
    del key
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    done = 8
    while True:
        ends = np.ones(n, bool)
        ends[:-1] = fresh[1:]
        tied = np.flatnonzero(~(fresh & ends))  # places in groups of several
        if len(tied) == 0:
            return order
        own = order[tied]
        # Zeros stood for what is behind the end: there, the shorter suffix comes first.
        behind = np.where(own + done < n, rank[np.minimum(own + done, n - 1)], n - 1 - own - done)
        key = (rank[own] << 32) + (behind + done)
        again = np.argsort(key)
        order[tied] = own[again]
        key = key[again]
        new = np.ones(len(tied), bool)
        new[1:] = key[1:] != key[:-1]
        fresh[tied] = new
        rank[order[tied]] = np.maximum.accumulate(np.where(new, tied, 0))
        done *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """For each place of ``order`` the bytes, ``limit`` at most, that its suffix shares with the one
    before.

    Kasai's recurrence along the text: a suffix shares at least one byte less than the suffix that
    starts one byte earlier. Stretches of the text are followed side by side, eight bytes at a time.
    """
    n = len(data)
    found = np.zeros(n, np.int64)
    if n < 2:
        return found
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([data, np.zeros(limit + 8, np.uint8)])
    words = words_at(padded)
    steps = -(-n // LANES)
    starts = np.arange(0, n, steps)
    shared = np.zeros(len(starts), np.int64)
    for t in range(steps):
        i = starts + t
        if i[-1] >= n:
            i = i[:-1]
            starts, shared = starts[: len(i)], shared[: len(i)]
        j = before[i]
        shared = np.maximum(shared - 1, 0)
        shared[j < 0] = 0
        lanes = np.flatnonzero(j >= 0)
        while len(lanes):
            at = shared[lanes]
            whole = at + 8
            differ = words[i[lanes] + at] ^ words[j[lanes] + at]
            equal = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3
            at += equal
            # No suffix goes on behind the end of the text.
            at = np.minimum(at, np.minimum(limit, n - np.maximum(i[lanes], j[lanes])))
            shared[lanes] = at
            lanes = lanes[(at == whole) & (at < limit)]
        found[i] = shared
    return found[order]
