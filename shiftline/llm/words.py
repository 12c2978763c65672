"""Word and shingle hashes of whole texts, computed in numpy over many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
GROUP = 1 << 18  # bytes handled at once; arrays of eight times this size stand beside them

_separator = np.zeros(256, bool)
_separator[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0][0]) < n:
        size = max(n, GROUP + 1)
        tables = []
        for base in (_PRIME, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers[:] = [tuple(tables)]
    return _powers[0]


def _hashed(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data``, and for each the number of the text it lies in.

    Texts lie one after the other; ``bounds`` are their starts and the end.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_separator[data]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | cut[1:n]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power, inverse = _tables(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_lower[data].astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    hashes = (total[stops] - total[starts]) * inverse[starts]
    hashes = mixed(hashes ^ ((stops - starts).astype(np.uint64) << np.uint64(40)))
    return hashes, np.searchsorted(bounds, starts, side="right") - 1


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end at white space, or where its word ends."""
    at = 0
    while at < len(data):
        end = min(at + GROUP, len(data))
        if end < len(data):
            found = np.flatnonzero(_separator[data[at:end]])
            if len(found):
                end = at + int(found[-1]) + 1
            else:
                rest = np.flatnonzero(_separator[data[end:]])
                end = end + int(rest[0]) if len(rest) else len(data)
        yield data[at:end]
        at = end


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, hashes, bounds) for groups of texts: the words of text k of the group are
    ``hashes[bounds[k]:bounds[k + 1]]``. A-Z counts as a-z; a null text has no words.

    Words are what stands between blanks, tabs and line ends. Hashes are of 64 bits.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = int(np.searchsorted(offsets, offsets[first] + GROUP, side="right")) - 1
        end = min(max(end, first + 1), len(texts))
        part = data[offsets[first] : offsets[end]]
        if len(part) > GROUP:  # a single long text
            hashes = np.concatenate([_hashed(p, np.array([0, len(p)]))[0] for p in _pieces(part)])
            bounds = np.array([0, len(hashes)])
        else:
            bytes_at = offsets[first : end + 1] - offsets[first]
            hashes, owner = _hashed(part, bytes_at)
            bounds = np.searchsorted(owner, np.arange(end - first + 1))
        yield first, end, hashes, bounds
        first = end


def shingle_set(words: np.ndarray, length: int = 5) -> np.ndarray:
    """Sorted distinct hashes of ``length`` words in a row; of all words if there are fewer."""
    if len(words) == 0:
        return words
    if len(words) < length:
        size, length = np.uint64(len(words)), len(words)
    else:
        size = np.uint64(length)
    total = np.full(len(words) - length + 1, size, np.uint64)
    for k in range(length):
        total = total * _PRIME + words[k : len(words) - length + 1 + k]
    return np.unique(mixed(total))
