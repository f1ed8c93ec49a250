"""Words of UTF-8 text as 64-bit hashes, without a loop over words.

A word is a run of ASCII letters and digits and of any characters beyond ASCII.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 20  # bytes of text cut into words at once

_WORD = np.zeros(256, bool)
for _span in (range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B), range(0x80, 0x100)):
    _WORD[list(_span)] = True
# two independent 64-bit values per byte and two odd multipliers; capitals count as small letters
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, (2, 256), np.uint64)
_BYTE[:, 0x41:0x5B] = _BYTE[:, 0x61:0x7B]
_FACTOR = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _powers(n: int, have=[np.ones((2, 1), np.uint64)]) -> np.ndarray:
    """Powers of the two multipliers, grown as longer words are met."""
    while have[0].shape[1] < n:
        old = have[0]
        have[0] = np.concatenate([old, old * (old[:, -1] * _FACTOR)[:, None]], axis=1)
    return have[0]


def _segment_words(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = _WORD[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    if not len(starts):
        return starts, *np.empty((2, 0), np.uint64)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    letters = raw[inside]
    place = np.arange(len(letters), dtype=np.int32) - np.repeat(first.astype(np.int32), sizes)
    power = _powers(int(sizes.max()))
    return starts, *[np.add.reduceat(_BYTE[k][letters] * power[k][place], first) for k in (0, 1)]


def words_of(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte and two 64-bit hashes of every word in UTF-8 bytes."""
    found, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + SEGMENT)
        while end < len(raw):  # go on to the next byte outside a word
            gap = np.flatnonzero(~_WORD[raw[end : end + SEGMENT]])
            end = end + int(gap[0]) if len(gap) else min(len(raw), end + SEGMENT)
            if len(gap):
                break
        starts, *hashes = _segment_words(raw[at:end])
        found.append((starts + at, *hashes))
        at = end
    if not found:
        return np.empty(0, np.int64), *np.empty((2, 0), np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))
