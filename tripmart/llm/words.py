"""Vectorised words and word shingles of many texts at once.

Texts are UTF-8 bytes. A word is a run without the six ASCII white-space
characters; A-Z count as a-z. Multi-byte characters hold no ASCII byte, so
working on bytes gives the same words as working on characters.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(20240501)
_LETTER = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[65:91] = _LETTER[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = np.array([0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
# Powers are made in these numbers; up to so many are kept for the next step.
_GRAIN, _KEPT = 1 << 17, 9 << 18
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    size = max(1, -(-n // _GRAIN)) * _GRAIN
    have = next(iter(_powers), 0)
    if have >= n:
        return _powers[have]
    up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    found = np.cumprod(up, out=up), np.cumprod(down, out=down)
    if size <= _KEPT:
        # Longer ones belong to one long text and go with it.
        _powers.clear()
        _powers[size] = found
    return found


def word_hashes(raw: np.ndarray, at: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word, and each text's first word.

    ``at`` holds the offsets of the texts in ``raw`` (one more than texts);
    byte positions are relative to ``at[0]``. ``blank`` marks the bytes between words.
    """
    raw, at = raw[at[0] : at[-1]], at - at[0]
    n = len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(at), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    letter = ~blank[raw]
    first = letter.copy()
    first[1:] &= ~letter[:-1] | edge[1:n]
    last = letter.copy()
    last[:-1] &= ~letter[1:] | edge[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_LETTER[raw] * up[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    return hashes, start, end, np.searchsorted(start, at)


def shingle_sets(raw: np.ndarray, at: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text as 64-bit values.

    A text of fewer words counts as one shingle, one without words has none.
    """
    words, _, _, first = word_hashes(raw, at)
    grams = np.zeros(0, np.uint64)
    if len(words) >= k:
        grams = words[: len(words) - k + 1] * _PLACE[0]
        for j in range(1, k):
            grams = grams + words[j : len(words) - k + 1 + j] * _PLACE[j % 5]
        grams = mix(grams)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            short = np.array([int(b - a) * 0xB5297A4D3F84D5B5 % (1 << 64)], np.uint64)
            out.append(mix((words[a:b] * _PLACE[: b - a]).sum(keepdims=True, dtype=np.uint64) + short))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
