"""Removal of long repeated byte strings by a logarithmic family of suffix arrays.

Every ``size``-byte window of a text belongs to one anchor, chosen from the
window's bytes alone, so equal windows have equal anchors (``anchors.runs``).
Windows whose anchor occurs once in the corpus are unique.  For the others the
byte content around the anchor goes to the task that owns the anchor's hash,
where a family of suffix arrays is kept: each arriving batch gets a suffix array
(its window suffixes in the order of the fingerprint of their first ``size``
bytes, which is all a scan for matches of that length needs), it is merge-scanned
against the existing levels, and levels of like size are merged, so a suffix is
merged a logarithmic number of times.

What the scans of the texts need to know about anchors is held in Bloom filters
of bounded size; a false positive costs work and never changes a result.
Content that many texts share travels once per task.  An anchor with more than
``HOT`` different surroundings is split by the window itself.

Defined results: a null text is empty; matches never cross texts; equal texts
repeat each other; repeated rows get equal results; rows may have null or equal
ids; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm import anchors
from wellspark.llm.common import checkpoint, slices, spread

HOT = 8192  # different surroundings of an anchor that one task may hold
FILTER_BITS = 1 << 28  # at most, in each of three filters: 32 MB
BLOCK = 1 << 13  # words of a filter that travel as one row, a power of two
PARTLY = 64  # blocks, about, that the driver gets at a time
SLICE = 2_000_000


class Levels:
    """Sorted fingerprint arrays of geometrically growing size, and a mark for
    every window that was met twice."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.marks = np.zeros(1 << 16, bool)
        self.used = 0

    def reserve(self, n: int) -> int:
        base = self.used
        self.used += n
        if self.used > len(self.marks):
            self.marks = np.concatenate([self.marks, np.zeros(max(len(self.marks), n), bool)])
        return base

    def add(self, key: np.ndarray, place: np.ndarray) -> None:
        """A batch: its suffix array is scanned against all levels."""
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
        same = key[1:] == key[:-1]
        self.marks[place[1:][same]] = True
        self.marks[place[:-1][same]] = True
        new = np.r_[True, ~same]
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        uniq, known = key[first], np.zeros(len(first), bool)
        for old, where in self.levels:
            at = np.minimum(np.searchsorted(old, uniq), len(old) - 1)
            hit = old[at] == uniq
            known |= hit
            self.marks[where[at[hit]]] = True
        self.marks[place[known[group]]] = True
        fresh = ~known
        if fresh.any():
            self.levels.append((uniq[fresh], place[first[fresh]]))
        while len(self.levels) > 1 and len(self.levels[-2][0]) <= 2 * len(self.levels[-1][0]):
            (ka, pa), (kb, pb) = self.levels.pop(), self.levels.pop()
            both = np.concatenate([ka, kb])
            order = np.argsort(both, kind="stable")  # merges the two sorted runs
            self.levels.append((both[order], np.concatenate([pa, pb])[order]))


def _texts(batch: pd.DataFrame) -> Iterator[tuple[list[int], list[bytes]]]:
    raw = [(t if isinstance(t, str) else "").encode("utf-8", "surrogatepass") for t in batch["text"]]
    for lo, hi in slices(map(len, raw), SLICE):
        yield list(range(lo, hi)), raw[lo:hi]


def _runs(raw: list[bytes], size: int):
    """Runs of all texts of a slice: (text number, first, last, anchor, content
    hash), first and last relative to the slice's joined bytes."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    out = []
    for i, (e, r) in enumerate(zip(ends, raw)):
        if len(r) >= size:
            f, l, a = anchors.runs(data[e - len(r):e], size)
            out.append((np.full(len(f), i), f + e - len(r), l + e - len(r), a))
    if not out:
        z = np.zeros(0, np.int64)
        return data, z, z, z, z.astype(np.uint64), z.astype(np.uint64), ends
    who, first, last, a = map(np.concatenate, zip(*out))
    return data, who, first, last, a, anchors.spans_hash(data, first, last + size), ends


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _census(size: int):
    """Per task and anchor: windows' runs, different contents, one of them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, raw in _texts(b):
                _, _, _, _, a, f, _ = _runs(raw, size)
                if len(a):
                    order = np.lexsort((f, a))
                    a, f = a[order], f[order]
                    new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (f[1:] != f[:-1])])
                    yield pd.DataFrame({"a": _signed(a[new]), "f": _signed(f[new]), "n": np.diff(np.r_[new, len(a)])})
    return run


def _bits(a: np.ndarray, size: int) -> list[np.ndarray]:
    """Two places in a filter of ``size`` bits (a power of two)."""
    a = a.view(np.uint64)
    return [(x % np.uint64(size)).astype(np.int64) for x in (a >> np.uint64(17), anchors.mix(a + np.uint64(3)))]


def bloom(rows: DataFrame, n: int) -> np.ndarray:
    """Filter of column ``a`` as packed bits: 16 bits a value up to the bound,
    or'ed together by word and laid out in blocks before anything reaches the
    driver, which holds the filter and a partition of blocks."""
    size = 1 << 16
    while size < 16 * n and size < FILTER_BITS:
        size <<= 1

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = np.unique(np.concatenate(_bits(b["a"].to_numpy(), size)))
            word, first = np.unique(at >> 6, return_index=True)
            if len(word):
                yield pd.DataFrame({"w": word, "v": _signed(np.bitwise_or.reduceat(
                    np.uint64(1) << (at & 63).astype(np.uint64), first))})

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: dict[int, np.ndarray] = {}
        for b in batches:
            w, v = b["w"].to_numpy(np.int64), b["v"].to_numpy(np.int64)
            for i in np.unique(w // BLOCK):
                own = w // BLOCK == i
                made.setdefault(int(i), np.zeros(BLOCK, np.int64))[w[own] % BLOCK] = v[own]
        for i, block in made.items():
            yield pd.DataFrame({"i": [i], "v": [block.tobytes()]})

    out = np.zeros(max(size // 64, BLOCK), np.uint64)
    parts = max(1, size // 64 // BLOCK // PARTLY)
    whole = rows.select("a").mapInPandas(words, "w long, v long").groupBy("w").agg(F.bit_or("v").alias("v"))
    dealt = checkpoint(whole.repartition(parts, F.col("w").bitwiseAND(F.lit(-BLOCK).cast("long"))).mapInPandas(blocks, "i long, v binary"))
    for r in dealt.toLocalIterator():
        out[r["i"] * BLOCK:(r["i"] + 1) * BLOCK] = np.frombuffer(bytes(r["v"]), np.uint64)
    return out[:size // 64]


def has(filter_words: np.ndarray, a: np.ndarray) -> np.ndarray:
    ok = np.ones(len(a), bool)
    for at in _bits(a, len(filter_words) * 64):
        ok &= (filter_words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return ok


def _contents(size: int, several, hot):
    """Rows for the index: the bytes around anchors with several contents, or
    the windows' fingerprints where the anchor is hot; each once per slice."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        many, crowd = several.value, hot.value
        for b in batches:
            for _, raw in _texts(b):
                data, _, first, last, a, f, _ = _runs(raw, size)
                keep = has(many, a)
                if not keep.any():
                    continue
                first, last, a, f = first[keep], last[keep], a[keep], f[keep]
                _, one, n = np.unique(f, return_index=True, return_counts=True)
                first, last, a, f = first[one], last[one], a[one], f[one]
                busy = has(crowd, a)
                cold = ~busy
                yield pd.DataFrame({"route": _signed(a[cold]), "a": _signed(a[cold]), "f": _signed(f[cold]),
                                    "at": np.zeros(cold.sum(), "int32"), "n": n[cold],
                                    "content": [data[x:y + size].tobytes() for x, y in zip(first[cold], last[cold])]})
                if busy.any():
                    count = (last - first + 1)[busy]
                    off = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    start = np.repeat(first[busy], count) + off
                    yield pd.DataFrame({"route": _signed(anchors.spans_hash(data, start, start + size)),
                                        "a": _signed(np.repeat(a[busy], count)), "f": _signed(np.repeat(f[busy], count)),
                                        "at": off.astype("int32"), "n": np.repeat(n[busy], count),
                                        "content": [None] * len(off)})
    return run


def _index(size: int):
    """The family of one task: all rows of its routes, batch by batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        family, known = Levels(), {}
        for b in batches:
            keys, places, twice = [], [], []
            content = b["content"].tolist()
            rows = list(zip(b["a"].tolist(), b["f"].tolist(), b["at"].tolist(), b["n"].tolist(), b["route"].tolist()))
            bytes_of, spot = [], []
            for i, (a, f, at, n, route) in enumerate(rows):
                count = 1 if content[i] is None else len(content[i]) - size + 1
                base = known.get((f, at))
                if base is not None:  # the same content from another task
                    twice.append((base[1], count))
                    continue
                base = family.reserve(count)
                known[f, at] = (a, base, count)
                if n > 1:
                    twice.append((base, count))
                if content[i] is None:
                    keys.append(np.array([route], np.int64).view(np.uint64))
                    places.append(np.array([base]))
                else:
                    bytes_of.append(content[i])
                    spot.append((base, count))
            if bytes_of:
                data = np.frombuffer(b"".join(bytes_of), np.uint8)
                begin = np.cumsum([0, *map(len, bytes_of)])[:-1]
                count = np.array([c for _, c in spot])
                off = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                start = np.repeat(begin, count) + off
                keys.append(anchors.spans_hash(data, start, start + size))
                places.append(np.repeat(np.array([x for x, _ in spot]), count) + off)
            if keys:
                family.add(np.concatenate(keys), np.concatenate(places))
            for base, count in twice:
                family.marks[base:base + count] = True
        out = []
        for (f, at), (a, base, count) in known.items():
            m = family.marks[base:base + count]
            if m.any():
                edge = np.flatnonzero(np.diff(np.r_[0, m.view(np.int8), 0]))
                out.append((a, f, (edge[::2] + at).tolist(), (edge[1::2] + at - 1).tolist()))
                if len(out) == 10_000:
                    yield pd.DataFrame(out, columns=["a", "f", "lo", "hi"])
                    out = []
        if out:
            yield pd.DataFrame(out, columns=["a", "f", "lo", "hi"])
    return run


def _occurrences(size: int, repeated):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        again, done = repeated.value, set()
        for b in batches:
            key = b["t"].tolist()
            for rows, raw in _texts(b):
                # a text met before in this task has the same occurrences
                new = [i for i, r in enumerate(rows) if key[r] not in done and not done.add(key[r])]
                if len(done) > 500_000:
                    done.clear()
                _, who, first, last, a, f, ends = _runs([raw[i] for i in new], size)
                keep = has(again, a)
                if keep.any():
                    start = ends - np.array([len(raw[i]) for i in new])
                    t = np.array([key[rows[i]] for i in new], np.int64)
                    yield pd.DataFrame({"t": t[who[keep]], "a": _signed(a[keep]), "f": _signed(f[keep]),
                                        "first": (first - start[who])[keep].astype("int32"),
                                        "count": (last - first + 1)[keep].astype("int32")})
    return run


def merged(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Union of byte ranges as maximal runs; touching ranges are one run."""
    out: list[tuple[int, int]] = []
    for x, y in sorted(zip(lo.tolist(), hi.tolist())):
        if out and x <= out[-1][1]:
            if y > out[-1][1]:
                out[-1] = (out[-1][0], y)
        else:
            out.append((x, y))
    return out


def _cut(size: int, texts: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, spans in zip(b["text"], b["spans"]):
                raw = (text if isinstance(text, str) else "").encode("utf-8", "surrogatepass")
                found = merged(*(np.array([s[k] for s in spans], np.int64) + d for k, d in (("lo", 0), ("hi", size)))) \
                    if spans is not None and len(spans) else []
                at, kept = 0, []
                for x, y in found:
                    kept.append(raw[at:x])
                    at = y
                left = b"".join([*kept, raw[at:]])
                rows.append((len(raw), len(raw) - len(left), len(found), left))
            out = pd.DataFrame({"id": b["id"].astype("Int64").values, "n_bytes": [r[0] for r in rows],
                                "n_removed": [r[1] for r in rows], "n_spans": [r[2] for r in rows],
                                "kept_sha256": [hashlib.sha256(r[3]).hexdigest() for r in rows]})
            yield out.assign(kept=[r[3] for r in rows]) if texts else out
    return run


def remove_repeats(docs: DataFrame, size: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   texts: bool = False) -> DataFrame:
    """One row per document row: the id, ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_sha256`` and, with ``texts``, the remaining bytes ``kept``.  Removed
    is each byte covered by a ``size``-byte string that starts elsewhere too."""
    sc = docs.sparkSession.sparkContext
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    body = src.where(F.octet_length("text") >= size).select("text")
    census = checkpoint(
        body.mapInPandas(_census(size), "a long, f long, n long").groupBy("a")
        .agg(F.sum("n").alias("n"), F.count("*").alias("c"), F.min("f").alias("f"), F.max("f").alias("f2"))
        .where("n > 1").select("a", "f", (F.col("f") != F.col("f2")).alias("several"), (F.col("c") > HOT).alias("hot")))
    count = census.agg(F.count("*").alias("n"), F.count_if("several").alias("s"), F.count_if(F.expr("several AND hot")).alias("h")).first()
    again, several, hot = (sc.broadcast(bloom(census.where(c), k)) for c, k in (
        ("true", count["n"]), ("several", count["s"]), ("several AND hot", count["h"])))

    routed = body.mapInPandas(_contents(size, several, hot), "route long, a long, f long, at int, n long, content binary")
    partly = spread(routed, "route").mapInPandas(_index(size), "a long, f long, lo array<int>, hi array<int>")
    # an anchor with one content repeats as a whole
    whole = census.where("NOT several").select("a", "f", F.lit(None).cast("array<int>").alias("lo"), F.lit(None).cast("array<int>").alias("hi"))
    status = partly.join(census.where("several").select("a"), "a", "left_semi").unionByName(whole)
    seen = (src.where(F.octet_length("text") >= size).select("text", F.xxhash64("text").alias("t"))
            .mapInPandas(_occurrences(size, again), "t long, a long, f long, first int, count int"))
    ranges = F.when(F.col("lo").isNull(), F.array(F.struct(
        F.col("first").alias("lo"), (F.col("first") + F.col("count") - 1).alias("hi")))).otherwise(F.zip_with(
            "lo", "hi", lambda x, y: F.struct((x + F.col("first")).alias("lo"), (y + F.col("first")).alias("hi"))))
    spans = (seen.join(status, ["a", "f"]).select("t", F.explode(ranges).alias("r"))
             .groupBy("t").agg(F.collect_set("r").alias("spans")))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")
    out = (src.withColumn("t", F.xxhash64("text")).join(spans, "t", "left").select("id", "text", "spans")
           .mapInPandas(_cut(size, texts), schema))
    return out.withColumnRenamed("id", id_col)
