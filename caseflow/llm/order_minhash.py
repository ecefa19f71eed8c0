"""Order MinHash: fingerprints whose likeness follows edit distance.

A text is the set of its k-mers of code points, each numbered by its occurrence. For each of SLOTS hash
functions the TUPLE k-mers of smallest hash are selected and kept in the order of the text; the hash of
that tuple is one slot of the fingerprint. Two texts agree in a slot if they select the same k-mers in
the same order, so both common content and its order count.
"""

from __future__ import annotations

import numpy as np

K = 6
TUPLE = 2
SLOTS = 64
# k-mers hashed at once under all functions; a longer text goes through in blocks
KMERS_AT_ONCE = 1 << 14

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    return (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Mask and odd factor of each hash function."""
    seeds = _mix((np.arange(1, 2 * SLOTS + 1, dtype=np.uint64)) * _M1) >> np.uint64(32)
    return seeds[:SLOTS].astype(np.uint32)[:, None], (seeds[SLOTS:] | np.uint64(1)).astype(np.uint32)[:, None]


_MASKS, _FACTORS = _functions()


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")


def numbered_kmers(points: np.ndarray) -> np.ndarray:
    """A 32-bit value for each k-mer in text order, equal for equal k-mers of equal occurrence number.

    A text shorter than K is a single k-mer; an empty text has none.
    """
    if not len(points):
        return np.zeros(0, np.uint32)
    k = min(K, len(points))
    n = len(points) - k + 1
    value = np.zeros(n, np.uint64)
    for i in range(k):
        value = value * _M1 + points[i : i + n]
    value = _mix(value)
    # equal k-mers stand together, in text order, once sorted by 32 bits of value and position
    order = np.sort((value & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64))
    at = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    kind = order >> np.uint64(32)
    index = np.arange(n)
    starts = np.where(np.append(True, kind[1:] != kind[:-1]), index, 0)
    occurrence = index - np.maximum.accumulate(starts)
    numbered = np.empty(n, np.uint32)
    numbered[at] = (_mix(kind + (occurrence.astype(np.uint64) + np.uint64(1)) * _M1) >> np.uint64(32)).astype(np.uint32)
    return numbered


def fingerprint(points: np.ndarray) -> np.ndarray:
    """SLOTS 32-bit slots; all zero for an empty text.

    Ties of a hash go to the earlier k-mer. A text with fewer k-mers than TUPLE uses what it has.
    """
    kmers = numbered_kmers(points)
    if not len(kmers):
        return np.zeros(SLOTS, np.uint32)
    top = np.uint32(0xFFFFFFFF)
    slots = np.arange(SLOTS)
    keep = min(TUPLE, len(kmers))
    hashes = np.zeros((SLOTS, 0), np.uint32)
    positions = np.zeros((SLOTS, 0), np.int64)
    for begin in range(0, len(kmers), KMERS_AT_ONCE):
        block = (kmers[None, begin : begin + KMERS_AT_ONCE] ^ _MASKS) * _FACTORS
        picked, where = [], []
        for _ in range(min(keep, block.shape[1])):
            at = block.argmin(axis=1)
            picked.append(block[slots, at])
            where.append(at + begin)
            block[slots, at] = top
        hashes = np.concatenate([hashes, np.stack(picked, 1)], 1)
        positions = np.concatenate([positions, np.stack(where, 1)], 1)
        best = np.argsort(hashes, axis=1, kind="stable")[:, :keep]
        hashes = np.take_along_axis(hashes, best, 1)
        positions = np.take_along_axis(positions, best, 1)
    chosen = kmers[np.sort(positions, axis=1)].astype(np.uint64)
    value = np.zeros(SLOTS, np.uint64)
    for i in range(keep):
        value = _mix(value * _M1 + chosen[:, i] + np.uint64(1))
    return (value >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal slots, 0 to 1."""
    return float(np.count_nonzero(a == b)) / SLOTS


def as_text(slots: np.ndarray) -> str:
    return slots.astype(">u4").tobytes().hex()
