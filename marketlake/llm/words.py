"""Words and word shingles of many texts at once, as numpy arrays of hashes."""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.default_rng(20240607)
BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = _RANDOM.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    if len(have := _POWERS.get(base, ())) < max(n, 1):
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        _POWERS[base] = np.multiply.accumulate(have)
    return _POWERS[base][:n]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each word; a word never crosses a document's end."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    first[cut] = inside[cut]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = cut[cut > 0] - 1
    last[cut] = inside[cut]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lower-cased; equal words have equal hashes wherever they stand."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[LOWER[data]] * powers(BASE, len(data)), out=sums[1:])
    return mixed((sums[end] - sums[start]) * powers(INVERSE, len(data) + 1)[start])


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of each run of `width` words; a shorter document gives its whole sequence as one."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(max(0, n - width + 1), np.uint64)
    for k in range(width):
        total += words[k : k + len(total)] * PLACE[k]
    own = doc[: len(total)] == doc[width - 1 :] if len(total) else np.zeros(0, bool)
    hashes, of = [mixed(total[own] + np.uint64(width))], [doc[: len(total)][own]]
    counts = np.bincount(doc, minlength=n_docs)
    begins = np.concatenate([[0], np.cumsum(counts)])
    for size in range(1, width):
        short = np.flatnonzero(counts == size)
        at = begins[short]
        whole = np.zeros(len(short), np.uint64)
        for k in range(size):
            whole += words[at + k] * PLACE[k]
        hashes.append(mixed(whole + np.uint64(size)))
        of.append(short)
    return np.concatenate(hashes), np.concatenate(of)
