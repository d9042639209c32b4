"""Simple-8b: unsigned ids packed into 64-bit words, a 4-bit selector and 60 bits of ids each.

Fixed values of the format. Selector: ids per word x bits per id.
  0: escape, the low 60 bits are an index into the list of ids of more than 60 bits
  1: 60x1   2: 30x2   3: 20x3   4: 15x4   5: 12x5   6: 10x6   7: 8x7
  8: 7x8    9: 6x10   10: 5x12  11: 4x15  12: 3x20  13: 2x30  14: 1x60
The first id of a word is in its lowest bits. No word holds ids of two blocks of BLOCK ids, so
every block can be decoded by itself, from the word that the block's offset names.
"""

from __future__ import annotations

import numpy as np

COUNTS = [1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1]
BITS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]
BLOCK = 4096
_COUNT_OF = np.array(COUNTS + [0], dtype=np.int64)
_LIMITS = np.array([1 << b for b in BITS[1:]], dtype=np.uint64)

_SMALL = (np.searchsorted(_LIMITS, np.arange(1 << 17, dtype=np.uint64), side="right") + 1).astype(np.int8)


def _selectors(ids: np.ndarray) -> np.ndarray:
    """The highest selector that holds each id; 15: none."""
    if int(ids.max()) < len(_SMALL):
        return _SMALL[ids]
    return (np.searchsorted(_LIMITS, ids, side="right") + 1).astype(np.int8)


def _all_of_next(fits: np.ndarray, count: int) -> np.ndarray:
    """Whether each item and those after it, ``count`` in all, fit (no entry where fewer are left)."""
    size = 1
    while size * 2 <= count and len(fits) > size:
        fits, size = fits[:-size] & fits[size:], size * 2
    rest = count - size
    return fits[:max(0, len(fits) - rest)] & fits[rest:] if rest else fits


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, escaped, offsets)``: the packed words, ids over 60 bits, first word of each block."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    least = _selectors(ids)
    place = (np.arange(n) % BLOCK).astype(np.int16)
    choice = np.where(least > 14, 0, 14).astype(np.int8)
    for k in range(13, 0, -1):  # ever more ids per word, where they fit
        count = COUNTS[k]
        fits = _all_of_next(least <= k, count)
        if not fits.any():
            break
        choice[:len(fits)][fits & (place[:len(fits)] <= BLOCK - count)] = k
    step, starts, i = _COUNT_OF[choice].tolist(), [], 0
    while i < n:
        starts.append(i)
        i += step[i]
    first = np.array(starts, dtype=np.int64)
    chosen = choice[first]
    words = np.zeros(len(first), dtype=np.uint64)
    escaped = first[chosen == 0]
    words[chosen == 0] = np.arange(len(escaped), dtype=np.uint64)
    for k in range(1, 15):
        which = np.flatnonzero(chosen == k)
        if len(which):
            word = np.full(len(which), k << 60, dtype=np.uint64)
            for j in range(COUNTS[k]):
                word |= ids[first[which] + j] << np.uint64(j * BITS[k])
            words[which] = word
    offsets = np.searchsorted(first, np.arange(0, n, BLOCK)).astype(np.uint32)
    return words, ids[escaped], offsets


def decode(words: np.ndarray, escaped: np.ndarray) -> np.ndarray:
    """All ids of ``words`` (whole blocks), without a loop over words."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT_OF[selector]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    begins = ends - counts
    for k in np.unique(selector):
        which = np.flatnonzero(selector == k)
        if k == 0:
            out[begins[which]] = escaped[(words[which] & np.uint64((1 << 60) - 1)).astype(np.int64)]
            continue
        mask = np.uint64((1 << BITS[k]) - 1)
        for j in range(COUNTS[k]):
            out[begins[which] + j] = (words[which] >> np.uint64(j * BITS[k])) & mask
    return out


def decode_block(words: np.ndarray, escaped: np.ndarray, offsets: np.ndarray, block: int) -> np.ndarray:
    """The ids of one block only."""
    end = int(offsets[block + 1]) if block + 1 < len(offsets) else len(words)
    return decode(words[int(offsets[block]):end], escaped)
