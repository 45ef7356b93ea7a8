"""Words and word shingles as numbers, for whole blocks of texts at once."""

from __future__ import annotations

import numpy as np

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
BLOCK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_HASH = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


def inverse(base: int) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words of lower-cased UTF-8 bytes; ASCII white space ends words."""
    space = IS_SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    base = MULTIPLIER
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(BYTE_HASH[LOWER[data]] * powers(len(data), base), out=sums[1:])
    back = powers(len(data) + 1, inverse(int(base)))
    return mix((sums[ends] - sums[starts]) * back[starts]
               + (ends - starts).astype(np.uint64)), starts, ends


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES):
    """Runs of texts of about ``limit`` bytes together, as (first, last + 1)."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= limit:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def shingle_sets(texts: list[bytes], width: int = 5):
    """For each text the sorted distinct 64-bit hashes of its word shingles.

    A text with fewer than ``width`` words has its whole word sequence as one shingle, one
    without words none. A-Z are lower-cased; bytes that are not ASCII stand as they are.
    """
    for first, last in blocks(texts):
        some = texts[first:last]
        data = np.frombuffer(b"\n".join(some), dtype=np.uint8)
        hashes, starts, _ = word_hashes(data)
        limits = np.cumsum([len(t) + 1 for t in some])
        bounds = np.concatenate(([0], np.searchsorted(starts, limits)))
        n = len(hashes)
        rolled = np.zeros(max(0, n - width + 1), dtype=np.uint64)
        for k in range(width):
            rolled = rolled * MULTIPLIER + hashes[k:n - width + 1 + k]
        rolled = mix(rolled)
        for i in range(len(some)):
            a, b = int(bounds[i]), int(bounds[i + 1])
            if b - a >= width:
                yield np.unique(rolled[a:b - width + 1])
            elif b > a:
                whole = np.asarray([b - a], dtype=np.uint64)
                for k in range(a, b):
                    whole = whole * MULTIPLIER + hashes[k:k + 1]
                yield mix(whole)
            else:
                yield np.zeros(0, dtype=np.uint64)
