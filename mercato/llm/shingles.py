"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

import numpy as np

from .common import Rolling, mix64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word (A-Z lower-cased) of all texts, and where each text's words begin."""
    n = len(data)
    edge = np.ones(n + 1, bool)
    blank = _BLANK[data]
    edge[1:n] = blank[1:] != blank[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    if n:
        starts, stops = at[:-1], at[1:]
        word = ~blank[starts]
        starts, stops = starts[word], stops[word]
    else:
        starts = stops = np.zeros(0, np.int64)
    return Rolling(_LOWER[data]).of(starts, stops), np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``words`` words, sorted by hash.

    A text of fewer words has its whole sequence as its one shingle, a text
    without words the empty set.
    """
    hashes, first = word_hashes(data, offsets)
    n = len(hashes) - words + 1
    chain = np.full(max(n, 0), words, np.uint64)
    for k in range(words if n > 0 else 0):
        chain = mix64(chain * np.uint64(3) + hashes[k:k + n])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= words:
            own = np.sort(chain[a:b - words + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for h in hashes[a:b]:
                whole = mix64(whole * np.uint64(3) + h)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_hash(own: np.ndarray) -> int:
    """One signed 64-bit hash of a set."""
    with np.errstate(over="ignore"):
        return int(mix64(mix64(own).sum(keepdims=True, dtype=np.uint64) + np.uint64(len(own))).view(np.int64)[0])
