"""Shingle hashes and bit votes in NumPy, shared by the fingerprint operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

# One bit per byte lane, and how often a byte lane can count.
LANES = np.uint64(0x0101010101010101)
LANE_MAX = 255


def shingles(text: str | None, words: int) -> list[bytes]:
    """Shingles of ``words`` words, repeats included; fewer words: the whole sequence; none: no shingle.

    A-Z is lower-cased and words are what the white space 0x20, 0x09-0x0D separates.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return []
    joined = b" ".join(found)
    if len(found) <= words:
        return [joined]
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.concatenate(([0], ends))[:len(found) - words + 1]
    return [joined[a:b] for a, b in zip(starts.tolist(), (ends[words - 1:] - 1).tolist())]


def slices(texts: list, size: int = 1 << 20) -> Iterator[slice]:
    """Consecutive slices of about ``size`` characters, so that a batch of long texts is taken in parts."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text or "")
        if held >= size or i + 1 == len(texts):
            yield slice(begin, i + 1)
            begin, held = i + 1, 0


def hashes(texts: list, words: int, hash_of: Callable[[bytes], int]) -> tuple[np.ndarray, np.ndarray]:
    """All shingle hashes of a batch of texts, one after another, and the number for each text."""
    values, sizes = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = [hash_of(s) for s in shingles(text, words)]
        sizes[i] = len(own)
        values.append(np.array(own, np.uint64))
    return (np.concatenate(values) if values else np.empty(0, np.uint64)), sizes


def bit_counts(values: np.ndarray, sizes: np.ndarray, weights: np.ndarray | None = None,
               heaviest: int = 1) -> np.ndarray:
    """How often each of the 64 bits is set, per text: (texts, 64). Bit 0 is the lowest.

    ``weights`` (whole numbers up to ``heaviest``) count a value more than once. Eight shifted masks
    hold the bits in byte lanes, which are added up over runs short enough not to overflow, so the
    memory stays near that of the hashes themselves.
    """
    most = LANE_MAX // heaviest
    counts = np.zeros((len(sizes), 64), np.int64)
    own = np.flatnonzero(sizes)
    if not len(own):
        return counts
    size = sizes[own]
    runs = -(-size // most)
    first = np.cumsum(runs) - runs
    place = np.arange(runs.sum()) - np.repeat(first, runs)
    begin = np.repeat(np.cumsum(size) - size, runs) + most * place
    found = np.empty((len(own), 64), np.int64)
    for k in range(8):
        lanes = (values >> np.uint64(k)) & LANES
        if weights is not None:
            lanes *= weights.astype(np.uint64)
        lanes = np.add.reduceat(lanes, begin)
        found[:, k::8] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8), first, axis=0, dtype=np.int64)
    counts[own] = found
    return counts


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """(rows, 64) booleans as unsigned 64-bit integers."""
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
