"""Words and shingle sets of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np

from recallspark.llm.hashing import chain, span_hashes

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, offsets)`` of the words ``[^\\x20\\x09-\\x0D]+`` of each text, A-Z in lower case."""
    encoded = [t.encode() for t in batch]
    codes = _LOWER[np.frombuffer(b"\n".join([*encoded, b""]), dtype=np.uint8)]
    inside = np.concatenate(([False], ~_SPACE[codes], [False]))
    begins = np.flatnonzero(inside[1:] & ~inside[:-1])
    ends = np.flatnonzero(inside[:-1] & ~inside[1:])
    limits = np.cumsum([len(e) + 1 for e in encoded])
    offsets = np.concatenate(([0], np.searchsorted(begins, limits)))
    return span_hashes(codes.astype(np.uint64) + np.uint64(1), begins, ends), offsets


def shingle_sets(batch: list[str], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct ``width``-word shingles of each text; a shorter text is one shingle, no words none."""
    words, offsets = word_hashes(batch)
    rows = max(0, len(words) - width + 1)
    runs = chain(*[words[i:i + rows] for i in range(width)]) if rows else words[:0]
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(runs[a:b - width + 1]))
        else:
            out.append(chain(*[words[i:i + 1] for i in range(a, b)]) if b > a else words[:0])
    return out
