"""Words of UTF-8 texts as 64-bit hashes, computed on whole byte arrays at once."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_BYTES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on all others."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


_TABLES = [powers(0), powers(0)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_TABLES[0]) < n:
        size = max(n, _BLOCK + 4096)
        _TABLES[:] = [powers(size), powers(size, _INVERSE)]
    return _TABLES[0], _TABLES[1]


def word_hashes(data: bytes, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of each word ``[^\\x20\\x09-\\x0D]+`` in ``data``, in blocks cut at blanks."""
    raw = np.frombuffer(data, np.uint8)
    if lower:
        raw = _LOWER[raw]
    blank = _BLANK[raw]
    edge = np.flatnonzero(np.diff(np.r_[True, blank, True].view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _BLOCK)))
        a, b = starts[first], ends[last - 1]
        power, inverse = _tables(b - a + 1)
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_BYTES[raw[a:b]] * power[: b - a], out=sums[1:])
        s, e = starts[first:last] - a, ends[first:last] - a
        hashes[first:last] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        first = last
    return hashes, starts, ends


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` numbers, in order."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        out = mix(out * _BASE + hashes[i : i + n])
    return out


def shingle_set(data: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a text with A-Z lower-cased; with fewer
    words the whole sequence is the one shingle; without words the set is empty."""
    words = word_hashes(data, lower=True)[0]
    return np.unique(gram_hashes(words, min(k, max(len(words), 1))))
