"""Periodic runs of words, found through a recompression grammar.

The words of a slice of texts are numbered, each text is closed by a mark of its
own, and the sequence is compressed level by level: first every block of equal
symbols becomes one symbol (run-length rule), then symbols are dealt into left
and right ones by a hash of their name and every left-right pair becomes one
symbol.  Names are given by content, so equal stretches are parsed alike but for
their ends.  How far two places agree is read from the grammar: climb while both
places stand on borders of the same symbols, step over the few that do not, and
descend into the first two that differ.  That is exact in either direction and
takes a few numpy steps a level for all pairs of places at once.

A run of period p and length of at least max(least, exponent * p) holds a
stretch of ``G = max(least - p, (exponent - 1) * p)`` places whose word equals
the one p further, hence a multiple of G.  So the grid of multiples of G, for
every p, meets every run; it has O(n log n) places, those with equal words are
extended, and of equal stretches the smallest period is kept.

Defined results: a null or empty text has no run and collapses to the empty
text; a null id does not matter, rows are separate documents; other columns are
ignored (they may have any name); an empty table gives an empty result.  A slice
holds ``SLICE`` characters or one text, so memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import slices
from wellspark.llm.shingles import mix

SLICE = 2_000_000  # characters compressed together
QUERIES = 500_000  # places extended at a time
SCHEMA = "id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


@dataclass
class Level:
    """Symbols, their blocks, and the blocks' pairs.  ``blk`` names the block of
    a symbol, ``first`` and ``pair_first`` where blocks and pairs begin (one
    more entry at the end); ``inner`` and ``up`` belong to the borders before
    each block and at the end: within a pair, and pairs before it."""
    sym: np.ndarray
    blk: np.ndarray
    first: np.ndarray
    name: np.ndarray
    inner: np.ndarray
    up: np.ndarray
    pair_first: np.ndarray

    def mirrored(self) -> Level:
        """The same level read from its end."""
        n, nb = len(self.sym), len(self.name)
        return Level(self.sym[::-1], nb - 1 - self.blk[::-1], n - self.first[::-1], self.name[::-1],
                     self.inner[::-1], self.up[-1] - self.up[::-1], nb - self.pair_first[::-1])


def named(codes: np.ndarray) -> np.ndarray:
    """Equal codes get equal small numbers."""
    return pd.factorize(codes)[0].astype(np.int64)


def grammar(words: np.ndarray) -> list[Level]:
    """Levels from the words up to a single symbol."""
    levels, sym = [], named(words)
    while len(sym) > 1:
        new = np.r_[True, sym[1:] != sym[:-1]]
        first = np.r_[np.flatnonzero(new), len(sym)]
        long = np.diff(first)
        head = sym[first[:-1]]
        name = head if len(head) == len(sym) else named(head * (long.max() + 1) + long)
        right = (mix(name.astype(np.uint64) + np.uint64(len(levels) * 7919 + 1)) & np.uint64(1)).astype(bool)
        inner = np.zeros(len(name) + 1, bool)
        inner[1:-1] = ~right[:-1] & right[1:]
        begin = np.flatnonzero(~inner[:-1])
        k = int(name.max()) + 1
        codes = name[begin]
        two = np.flatnonzero(inner[begin + 1])
        codes[two] = (codes[two] + 1) * k + name[begin[two] + 1]
        levels.append(Level(sym, np.cumsum(new) - 1, first, name, inner,
                            np.r_[0, np.cumsum(~inner[:-1])], np.r_[begin, len(name)]))
        sym = named(codes)
    return levels


def agree(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many words from ``x`` on equal those from ``y`` on (x < y, words
    closed by marks that occur once)."""
    start, at, out = x, np.arange(len(x)), np.zeros(len(x), np.int64)
    symbols, blocks = [], []  # where places differ at a level: (query, x, y)
    for lv in levels:
        bx, by = lv.blk[x], lv.blk[y]
        rx, ry = lv.first[bx + 1] - x, lv.first[by + 1] - y
        equal = lv.sym[x] == lv.sym[y]
        whole = (lv.first[bx] == x) & (lv.first[by] == y)
        climb = equal & (rx == ry)
        step = np.where(equal, np.minimum(rx, ry), 0)
        stop = ~climb
        symbols.append((at[stop], (x + step)[stop], (y + step)[stop]))
        over = (~whole[climb]).astype(np.int64)
        at, bx, by = at[climb], bx[climb] + over, by[climb] + over
        split = lv.inner[bx] | lv.inner[by]
        same = lv.name[bx] == lv.name[by]
        stop = split & ~same
        blocks.append((at[stop], bx[stop], by[stop]))
        on = ~stop
        over = split[on].astype(np.int64)
        at, x, y = at[on], lv.up[bx[on] + over], lv.up[by[on] + over]
        if not len(at):
            break
    at, x, y = (np.zeros(0, np.int64) for _ in range(3))
    for t in range(len(symbols) - 1, -1, -1):
        lv = levels[t]
        bx, by = lv.pair_first[x], lv.pair_first[y]
        over = (lv.name[bx] == lv.name[by]).astype(np.int64)
        at, bx, by = (np.r_[p, q] for p, q in zip((at, bx + over, by + over), blocks[t]))
        x, y = lv.first[bx], lv.first[by]
        over = np.where(lv.sym[x] == lv.sym[y], np.minimum(lv.first[bx + 1] - x, lv.first[by + 1] - y), 0)
        at, x, y = (np.r_[p, q] for p, q in zip((at, x + over, y + over), symbols[t]))
    out[at] = x - start[at]
    return out


def runs_of(words: list[np.ndarray], least: int, exponent: int) -> list[np.ndarray]:
    """Per text the rows (start, length, period) of its runs, by start, then
    period.  Words are numbers from 0 that name them across all texts."""
    n = np.array([len(w) for w in words], np.int64)
    order = np.argsort(-n, kind="stable")
    order = order[n[order] >= max(least, exponent)]
    empty = [np.zeros((0, 3), np.int64)] * len(words)
    if not len(order):
        return empty
    top = max(int(words[d].max()) for d in order) + 1
    # the longest texts first: a prefix has all that are long enough for a period
    ends = np.cumsum(n[order] + 1) + 1
    seq = np.concatenate([[top], *(np.r_[words[d], top + 1 + k] for k, d in enumerate(order))]).astype(np.int64)
    owner = np.repeat(np.arange(len(order)), n[order] + 1)
    levels = grammar(seq)
    back = [lv.mirrored() for lv in levels]
    found, places, periods, waiting = [], [], [], 0

    def extend():
        x, p = np.concatenate(places), np.concatenate(periods)
        own = owner[x - 1] == owner[x + p - 1]
        x, p = x[own], p[own]
        after = agree(levels, x, x + p)
        # mirrored, the place that comes first is the later one
        before = agree(back, len(seq) - x - p, len(seq) - x)
        ok = before + after + p >= np.maximum(least, exponent * p)
        found.append(np.unique(np.c_[x - before, before + after + p, p][ok], axis=0))
        places.clear()
        periods.clear()

    for p in range(1, int(n[order[0]]) // exponent + 1):
        enough = int(np.searchsorted(-n[order], -max(least, exponent * p), side="right"))
        if not enough:
            break
        end, grid = int(ends[enough - 1]), max(least - p, (exponent - 1) * p)
        lo = seq[grid:end - p:grid]
        hit = np.flatnonzero(lo == seq[grid + p:end:grid][:len(lo)])
        if len(hit):
            places.append((hit + 1) * grid)
            periods.append(np.full(len(hit), p, np.int64))
            waiting += len(hit)
            if waiting >= QUERIES:
                extend()
                waiting = 0
    if places:
        extend()
    if not found:
        return empty
    # of equal stretches the smallest period
    f = np.concatenate(found)
    f = f[np.lexsort((f[:, 2], f[:, 1], f[:, 0]))]
    f = f[np.r_[True, (f[1:, :2] != f[:-1, :2]).any(axis=1)][:len(f)]]
    f = f[np.lexsort((f[:, 2], f[:, 0]))]
    doc = owner[f[:, 0] - 1]
    f[:, 0] -= np.r_[1, ends[:-1]][doc]
    cut = np.searchsorted(doc, np.arange(len(order) + 1))
    for k, d in enumerate(order):
        empty[d] = f[cut[k]:cut[k + 1]]
    return empty


def kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: those in no run past its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def _find(least: int, exponent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            for lo, hi in slices((len(t) for t in texts), SLICE):
                split = [t.encode("utf-8", "replace").split() for t in texts[lo:hi]]  # at the six ASCII blanks
                ids = pd.factorize(np.array([w for s in split for w in s] + [b""], object))[0]
                places = np.cumsum([0, *(len(s) for s in split)])
                rows, left = [], []
                for s, r in zip(split, runs_of([ids[x:y] for x, y in zip(places[:-1], places[1:])], least, exponent)):
                    rows.append([{"start": int(x), "length": int(y), "period": int(p)} for x, y, p in r])
                    stay = kept(len(s), r) if len(r) else None
                    left.append(b" ".join(s if stay is None else [w for w, k in zip(s, stay) if k]).decode())
                yield pd.DataFrame({"id": b["id"].iloc[lo:hi].values, "runs": rows, "collapsed": left})
    return run


def find_runs(docs: DataFrame, least: int = 24, exponent: int = 3,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``runs`` (maximal stretches of words with a smallest
    period q that are at least max(least, exponent * q) long, by start, then
    period) and the ``collapsed`` text, in which of every run only the first
    period is left (words joined by one blank)."""
    if least < 2 or exponent < 2:
        raise ValueError("least and exponent must be 2 or more")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(_find(least, exponent), SCHEMA).withColumnRenamed("id", id_col)


def echoed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text): in a tenth of the rows, by the crc32 of the id, the words from
    some place on repeat with a period, both given by the same number."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text_col, F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    rows = docs.select(F.col(id_col), F.col(text_col), h.alias("h"), g.alias("g")).select(
        id_col, text_col, "g", F.when((F.col("h") % 10 == 0), words).alias("w"))
    rows = rows.withColumn("n", F.size("w"))
    a = F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int")
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    rows = rows.withColumn("a", a).withColumn("p", p)
    turned = F.concat(F.slice("w", F.lit(1), F.col("a")), F.transform(
        F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.element_at("w", F.col("a") + (i - F.col("a")) % F.col("p") + 1)))
    return rows.select(id_col, F.when(F.col("n") > 0, F.array_join(turned, " ")).otherwise(F.col(text_col)).alias(text_col))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row the run count, the run with the greatest length to period (ties:
    smallest start, then period) and hashes of runs and collapsed text."""
    def better(best, r):
        x, y = r["length"] * best["period"], best["length"] * r["period"]
        return F.when(best["period"].isNull() | (x > y), r).otherwise(best)  # runs come by start, then period

    none = F.struct(*[F.lit(None).cast("long").alias(c) for c in ("start", "length", "period")])
    line = F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", F.aggregate("runs", none, better)).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
