"""Word shingles of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from wellspark.llm.common import slices

U = np.uint64
SLICE = 1_000_000  # characters hashed at a time


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (multiply and xor-shift rounds)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(31))) * U(0x9E6C63D0876A9A35)
        x = (x ^ (x >> U(29))) * U(0xD6E8FEB86659FD93)
        return x ^ (x >> U(32))


def series(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x2545F4914F6CDD1D) + U(seed))


BYTE = series(1, 256)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = U(0xB492B66FBE98F273)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


class Powers:
    """BASE**i and BASE**-i modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, U)

    def get(self, n: int):
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                self.up, self.down = (np.multiply.accumulate(np.r_[U(1), np.full(n, b, U)]) for b in (BASE, INVERSE))
        return self.up[:n], self.down


POWERS = Powers()


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, and the first word's place of each text
    (one more place at the end)."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    data = LOWER[np.frombuffer(b" ".join([*raw, b""]) + b" ", np.uint8)]
    gap = SPACE[data]
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    if len(gap) and not gap[0]:
        starts = np.r_[0, starts]
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    up, down = POWERS.get(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, U)
        np.cumsum(BYTE[data] * up[:len(data)], out=total[1:])
        h = (total[ends] - total[starts]) * down[starts] + (ends - starts).astype(U) * U(0xA0761D6478BD642F)
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return mix(h), np.searchsorted(starts, bounds)


def sets(texts: list[str | None], n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, values, places): the distinct n-word shingles of each
    text, sorted within a text; ``places`` has one more entry than rows.  A text
    of fewer words has its whole sequence as one shingle, one without words
    none."""
    texts = [t if isinstance(t, str) else "" for t in texts]
    weight = series(7, n) | U(1)
    for lo, hi in slices((len(t) for t in texts), SLICE):
        h, first = words(texts[lo:hi])
        count = np.diff(first)
        with np.errstate(over="ignore"):
            full = np.zeros(max(len(h) - n + 1, 0), U)
            for k in range(n):
                full += h[k:k + len(full)] * weight[k]
        full = mix(full)
        out, places = [], [0]
        for f, c in zip(first[:-1], count):
            if c >= n:
                s = np.unique(full[f:f + c - n + 1])
            elif c:
                with np.errstate(over="ignore"):
                    s = mix(np.array([(h[f:f + c] * weight[:c]).sum(dtype=U) + U(c) * U(0x8EBC6AF09C88C6E3)]))
            else:
                s = np.zeros(0, U)
            out.append(s)
            places.append(places[-1] + len(s))
        yield lo, hi, np.concatenate(out) if out else np.zeros(0, U), np.array(places)
