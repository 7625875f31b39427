"""Word and shingle hashes of one text, and minwise values of many sets (NumPy)."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_A = np.uint64(0xBF58476D1CE4E5B9)
_B = np.uint64(0x94D049BB133111EB)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer."""
    values = (values ^ (values >> np.uint64(30))) * _A
    values = (values ^ (values >> np.uint64(27))) * _B
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``size`` words.

    Words are separated by ASCII white space and compared with A-Z lower-cased. A text
    of fewer words is one shingle; one without words has none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    hashes = np.fromiter(map(digest, words), np.uint64, len(words))
    width = min(size, len(words))
    count = len(words) - width + 1
    value = np.full(count, width, np.uint64)
    for k in range(width):
        value = mix(value * _MIX + hashes[k:k + count])
    return np.unique(value)


def fingerprint(values: np.ndarray) -> bytes:
    """16 bytes that stand for a whole set."""
    return xxhash.xxh3_128_digest(values.tobytes())


def minwise(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """For each non-empty set the minwise value under every one of ``coordinates`` hashes."""
    rng = np.random.default_rng(20)
    salts = rng.integers(0, 2**63, (coordinates, 2)).astype(np.uint64)
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), coordinates), np.uint64)
    for c in range(coordinates):
        hashed = (flat ^ salts[c, 0]) * (salts[c, 1] | np.uint64(1))
        out[:, c] = np.minimum.reduceat(hashed, starts)
    return out
