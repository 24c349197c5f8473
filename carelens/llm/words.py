"""Words of a whole batch of texts at once: where they are and what they hash to."""

from __future__ import annotations

import numpy as np

from carelens.llm.common import Rolling, mix64

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that separate words: white space alone, or all ASCII but letters and digits.
WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each text (with the total at the end)."""
    n = len(data)
    inside = ~gaps[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[heads] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[heads[1:] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


_BYTES: dict[int, Rolling] = {}


def byte_hashes(seed: int) -> Rolling:
    if seed not in _BYTES:
        _BYTES[seed] = Rolling(256, seed)
    return _BYTES[seed]


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of the lower-cased words."""
    roll = byte_hashes(seed)
    return mix64(roll.of(roll.sums(LOWER[data]), start, end))
