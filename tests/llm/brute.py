"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np


def find_root(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def union(parent, a, b):
    a, b = find_root(parent, a), find_root(parent, b)
    if a != b:
        parent[max(a, b)] = min(a, b)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text, n):
    w = words(text)
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def near_duplicates(rows, n, num, den=100):
    """{id: (set size, component)} of unique ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    parent = {i: i for i in sets}
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) * den >= len(x | y) * num:
                union(parent, a, b)
    return {i: (len(sets[i]), find_root(parent, i)) for i in ids}


def contained(docs, items, n=5, percent=80):
    out = set()
    for i, t in items:
        s = shingles(t, n)
        for d, u in docs:
            c = len(s & shingles(u, n))
            if s and c * 100 >= len(s) * percent:
                out.add((d, i, c, len(s)))
    return out


def remove_repeats(texts, size):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + size] for r in raw for i in range(len(r) - size + 1))
    out = []
    for r in raw:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - size + 1):
            if count[r[i:i + size]] > 1:
                gone[i:i + size] = True
        runs = int((np.diff(np.r_[0, gone.astype(np.int8)]) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def base_secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end(), "assign"))
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    out.sort()
    return ([sum(o[1] == k for o in out) for k in range(3)],
            hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in out).encode()).hexdigest())


def vector_links(rows, threshold):
    """{id: (links, component)} of unique ids."""
    unit = {}
    for i, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            a = np.array(v, float) / max(map(abs, v))
            unit[i] = a / np.linalg.norm(a)
    parent, n = {i: i for i, _ in rows}, Counter()
    ids = sorted(unit)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                n[a] += 1
                n[b] += 1
                union(parent, a, b)
    return {i: (n[i], find_root(parent, i)) for i, _ in rows}
