"""Anchors: content-defined cuts of texts into runs of fixed-length windows."""

from __future__ import annotations

import numpy as np

from wellspark.llm.shingles import BASE, BYTE, POWERS, U, mix

GRAM = 32  # bytes hashed at an anchor


def gram_hashes(data: np.ndarray, k: int = GRAM) -> np.ndarray:
    """Hash of the k bytes from each position."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    up, down = POWERS.get(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE[data] * up[:len(data)], out=total[1:])
        return mix((total[k:] - total[:n]) * down[:n])


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Smallest of every ``w`` consecutive values, by prefix and suffix minima
    of blocks."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    pad = np.full(-len(x) % w, np.iinfo(x.dtype).max, x.dtype)
    block = np.concatenate([x, pad]).reshape(-1, w)
    before = np.minimum.accumulate(block, axis=1).ravel()
    after = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1:w - 1 + n])


def runs(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor hash) of each run of consecutive
    ``size``-byte windows that share an anchor: the position of the smallest
    gram hash in the window, leftmost on ties.  It depends on the window's bytes
    alone, so equal windows have equal anchor hashes."""
    h = gram_hashes(data)
    w = size - GRAM + 1
    if len(h) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    place = np.arange(len(h), dtype=U)
    low = window_minima((h & ~U(0xFFFFFFFF)) | place, w)  # 32 bits of hash, then the position
    at = (low & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:] - 1, len(at) - 1]
    return first, last, h[at[first]]


def spans_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range [start, end)."""
    up, down = POWERS.get(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE[data] * up[:len(data)], out=total[1:])
        return mix((total[end] - total[start]) * down[start] + (end - start).astype(U) * U(0x9FB21C651E98DF25))
