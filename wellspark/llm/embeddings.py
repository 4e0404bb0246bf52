"""Embedding near-duplicates through an inverted multi-index.

Vectors are normalised in double precision.  Each half of the vector has its own
codebook (k-means on a bounded, documented sample that grows with the codes);
the pair of nearest codes names a cell of the product grid and every vector is
indexed in its cell.  A query visits cells in the order of the sum of its two
halves' squared distances (multi-sequence traversal of the two sorted distance
lists).  How many cells it visits is learned on vectors the codebooks have not
seen, and raised where the links that a brute force finds between some of these
and all vectors need more; a grid too fine for the data gives way to a coarser
one, down to one cell, which compares all.  Candidates are verified by the
exact cosine.

Equal vectors are one entry with a count.  A cell's entries are dealt into
blocks of bounded size and its visitors likewise; a task compares one block of
visitors with one block of entries, so a hot cell becomes many tasks and no
pair of a group is written out: a task returns counts of links per vector and
the edges of a spanning forest of the links it saw.

Defined results: vectors that are null, zero or with null or non-finite
components link with nothing, as do rows with a null id; vectors of different
lengths link with nothing of the other, every length has an index of its own;
rows with the same id are separate vectors; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import checkpoint
from wellspark.llm.components import components

# Bounds of the fit: vectors sampled for the codebooks (at least ``PER_CODE`` a
# code, at most ``SAMPLE_VALUES`` numbers on the driver), k-means passes, unseen
# vectors for the visits, and those of them compared with every vector.
SAMPLE, PER_CODE, SAMPLE_VALUES, PASSES = 8_000, 32, 4_000_000, 12
HELD, QUERIES = 1_000, 256
VISIT = 500  # comparisons that cost as much as one more copy of a vector
CELL_ROWS = 40  # entries per used cell aimed at when choosing the grid
BLOCK = 512  # entries of a cell, or its visitors, in one task's block
MARGIN = 1e-9  # the threshold is decided in double precision


@dataclass(frozen=True)
class Index:
    books: tuple[np.ndarray, np.ndarray]
    visits: int


def kmeans(x: np.ndarray, k: int, passes: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centre = x[rng.choice(len(x), size=min(k, len(x)), replace=False)].copy()
    for _ in range(passes):
        near = nearest(x, centre)
        for j in range(len(centre)):
            own = x[near == j]
            if len(own):
                centre[j] = own.mean(axis=0)
    return centre


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1), 0)


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[lo:lo + 4096], book).argmin(axis=1) for lo in range(0, max(1, len(x)), 4096)])


def traverse(da: np.ndarray, db: np.ndarray, visits: int) -> list[int]:
    """The ``visits`` grid cells with the smallest sum of distances, nearest
    first: both distance lists are sorted and a heap walks the sums."""
    oa, ob = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
    sa, sb = da[oa], db[ob]
    heap, seen, out = [(sa[0] + sb[0], 0, 0)], {(0, 0)}, []
    while heap and len(out) < visits:
        _, i, j = heapq.heappop(heap)
        out.append(int(oa[i]) * len(db) + int(ob[j]))
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(sa) and q < len(sb) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (sa[p] + sb[q], p, q))
    return out


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = x.shape[1] // 2
    return x[:, :h], x[:, h:]


def cells(x: np.ndarray, index: Index, visits: int) -> list[list[int]]:
    a, b = halves(x)
    return [traverse(p, q, visits) for p, q in zip(distances(a, index.books[0]), distances(b, index.books[1]))]


def needed(x: np.ndarray, y: np.ndarray, books: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Visits that let ``x[r]`` and ``y[r]`` meet: the place of the one's cell in
    the other's order of all cells, of either side the smaller."""
    dx, dy = ([distances(h, b) for h, b in zip(halves(v), books)] for v in (x, y))

    def place(near, far):
        own = [d.argmin(axis=1) for d in far]
        out = np.empty(len(near[0]), "int64")
        for r, (da, db) in enumerate(zip(*near)):
            s = da[own[0][r]] + db[own[1][r]]
            out[r] = np.searchsorted(np.sort(db), s * (1 + 1e-12) + 1e-12 - da, side="right").sum()
        return out

    return np.maximum(np.minimum(place(dx, dy), place(dy, dx)), 1)


def visits_for(ranks: np.ndarray, weights: np.ndarray, recall: float) -> int:
    """The fewest visits that find ``recall`` of the links."""
    order = np.argsort(ranks, kind="stable")
    found = np.cumsum(weights[order])
    return int(ranks[order][np.searchsorted(found, recall * found[-1] * (1 - 1e-12))])


def cost(rows: int, k: int, visits: int) -> float:
    """Comparisons a vector, its copies among them: blocks of a cell's entries
    meet all blocks of its visitors."""
    own = rows / (k * k)
    return VISIT * (np.ceil(visits * own / BLOCK) + visits * np.ceil(own / BLOCK)) + visits * own


def at_threshold(some: np.ndarray, threshold: float) -> np.ndarray:
    """Rotated vectors at the threshold, the hardest links there are."""
    side = np.random.default_rng(9).normal(size=some.shape)
    side -= (side * some).sum(1)[:, None] * some
    norm = np.linalg.norm(side, axis=1)[:, None]
    return threshold * some + (1 - threshold ** 2) ** 0.5 * side / np.where(norm > 0, norm, 1)


def _links_of(queries: np.ndarray, counts: np.ndarray, books: tuple[np.ndarray, np.ndarray], threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Links of the queries by visits needed: how many, and how many rows' pairs."""
        for b in batches:
            for lo in range(0, len(b), 2000):
                part = b.iloc[lo:lo + 2000]
                x = np.array(part["v"].tolist(), float)
                cos = x @ queries.T
                i, j = np.nonzero((cos >= threshold) & (cos < 1 - 1e-12))
                if len(i):
                    places = np.concatenate([needed(x[i[at:at + 2000]], queries[j[at:at + 2000]], books)
                                             for at in range(0, len(i), 2000)])
                    rank, at = np.unique(places, return_inverse=True)
                    yield pd.DataFrame({"rank": rank, "n": np.bincount(at).astype(float),
                                        "m": np.bincount(at, part["c"].to_numpy()[i] * counts[j])})
    return run


def fit(vectors: DataFrame, rows: int, threshold: float, recall: float, sample: int = SAMPLE) -> Index:
    """Codebooks and visits for the distinct vectors (id, v, c).  The sample has
    the vectors of the smallest hashes; its first part is held out of the
    codebooks.  The visits are the fewest that find ``recall`` of the links
    between held-out vectors and rotations of them at the threshold, and of the
    links that brute force finds between held-out vectors and all vectors."""
    k = int(max(1, round((rows / CELL_ROWS) ** 0.5)))
    width = len(vectors.select("v").first()["v"])
    want = HELD + min(max(sample, PER_CODE * k), max(PER_CODE, SAMPLE_VALUES // width))
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    got = (vectors.select("id", "v", "c", share.alias("h")).where(F.col("h") <= int((1 << 30) * min(1.0, want / rows)))
           .toPandas().sort_values(["h", "id"]))  # about ``want`` rows
    x = np.array(got["v"].tolist(), float)
    held = min(HELD, len(x) // 5)
    unseen, x = x[:held], x[held:]
    k = min(k, len(x) // PER_CODE)
    if k < 2 or not held:
        return Index(tuple(h[:1] for h in halves(np.zeros((1, width)))), 1)  # one cell: all pairs
    other, best = at_threshold(unseen, threshold), None
    while k:
        books = tuple(kmeans(h, k, PASSES, 5 + i) for i, h in enumerate(halves(x)))
        visits = visits_for(needed(unseen, other, books), np.ones(held), recall)
        price = cost(rows, k, visits)
        if best is None or price < best[0]:
            best = price, books, visits
        k //= 2
    _, books, visits = best
    hits = vectors.select("v", "c").mapInPandas(
        _links_of(unseen[:QUERIES], got["c"].to_numpy()[:held][:QUERIES].astype(float), books, threshold),
        "rank long, n double, m double").groupBy("rank").agg(F.sum("n").alias("n"), F.sum("m").alias("m")).toPandas()
    for weight in ("n", "m") if len(hits) else ():
        visits = max(visits, visits_for(hits["rank"].to_numpy(), hits[weight].to_numpy(), recall))
    return Index(books, visits)


def forest(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A spanning forest of the links: (smallest member, member) of each tree."""
    nodes, flat = np.unique(np.r_[left, right], return_inverse=True)
    a, b = flat[:len(left)], flat[len(left):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return np.c_[nodes[label[own]], nodes[own]]


def _place(index: Index):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 2000):
                part = b.iloc[lo:lo + 2000]
                seen = cells(np.array(part["v"].tolist(), float), index, index.visits)
                yield part.assign(home=[c[0] for c in seen], seen=[np.array(c, "int32") for c in seen])
    return run


def _compare(threshold: float):
    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        """One block of visitors against one block of entries of one cell."""
        cell = int(key[0])
        own, guest = b[b["entry"]], b[~b["entry"]]
        out = {"id": [], "links": [], "other": []}
        if len(own) and len(guest):
            x, y = (np.array(p["v"].tolist(), float) for p in (guest, own))
            i, j = np.nonzero(x @ y.T >= threshold - MARGIN)
            gi, oi = guest["id"].to_numpy(), own["id"].to_numpy()
            cos = (x[i] * y[j]).sum(1)
            ok = (cos >= threshold) & (gi[i] != oi[j])
            i, j = i[ok], j[ok]
            if len(i):
                gh = guest["home"].to_numpy()
                # the pair is met once more if the entry's vector visits the visitor's cell
                meets = {c: np.array([c in s for s in own["seen"]]) for c in np.unique(gh[i]).tolist()}
                back = np.array([meets[h][e] for h, e in zip(gh[i].tolist(), j.tolist())])
                gc, oc = guest["c"].to_numpy(), own["c"].to_numpy()
                ids = np.r_[gi[i], oi[j][~back]]
                n = np.r_[oc[j], gc[i][~back]]
                u, at = np.unique(ids, return_inverse=True)
                tree = forest(gi[i], oi[j])
                out = {"id": np.r_[u, tree[:, 1]], "links": np.r_[np.bincount(at, n).astype("int64"), np.zeros(len(tree), "int64")],
                       "other": np.r_[np.full(len(u), -1), tree[:, 0]]}
        return pd.DataFrame(out).astype({"id": "int64", "links": "int64", "other": "int64"}).assign(edge=lambda d: d["links"] == 0)[["id", "links", "other", "edge"]]
    return run


def unit_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): ``v`` has length 1, or is null where the row links with nothing."""
    src = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("e"))
    fine = (F.size("e") > 0) & F.forall("e", lambda t: t.isNotNull() & ~F.isnan(t) & (F.abs(t) < float("inf")))
    # divided by the largest component first: squares neither overflow nor vanish
    top = F.array_max(F.transform("e", lambda t: F.abs(t)))
    z = F.when(F.col("id").isNotNull() & fine & (top > 0), F.zip_with(
        "e", F.array_repeat(top, F.size("e")), lambda t, m: t / m))
    norm = F.sqrt(F.aggregate("z", F.lit(0.0), lambda a, t: a + t * t))
    return src.withColumn("z", z).select("id", F.zip_with(
        "z", F.array_repeat(norm, F.size("z")), lambda t, n: t / n).alias("v"))


def near_duplicates(rows: DataFrame, threshold: float = 0.95, recall: float = 0.97, id_col: str = "vec_id",
                    vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """One row per vector: the id, ``n_links``, ``component_id`` and ``kept``."""
    keyed = unit_vectors(rows, id_col, vector_col).select(
        "id", "v", F.when(F.col("v").isNotNull(), F.xxhash64("v")).alias("k"),
        F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(1), "v")).alias("k2"))
    classes = checkpoint(keyed.where("v IS NOT NULL").groupBy("k", "k2").agg(
        F.any_value("v").alias("v"), F.min("id").alias("rep"), F.count("*").alias("c")))
    # an index of its own for every length of vectors: a row for each length
    sizes = classes.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy("w").collect()
    hits = None
    for s in sizes:
        own = classes.where(F.size("v") == s["w"]).select(F.col("k").alias("id"), "v", "c")
        found = linked(own, fit(own, s["n"], threshold, recall, sample), threshold)
        hits = found if hits is None else hits.unionByName(found)
    if hits is not None:
        links = hits.where("NOT edge").groupBy(F.col("id").alias("k")).agg(F.sum("links").alias("links"))
        label = components(hits.where("edge").select(F.col("other").alias("a"), F.col("id").alias("b")))
        classes = (classes.select("k", "k2", "rep", "c").join(links, "k", "left")
                   .join(label.withColumnRenamed("node", "k"), "k", "left")
                   .withColumn("root", F.coalesce("root", "k")))
        least = classes.groupBy("root").agg(F.min("rep").alias("component_id"))
        classes = classes.join(least, "root")
    else:
        classes = classes.select("k", "k2", "c", F.lit(0).alias("links"), F.col("rep").alias("component_id"))
    out = keyed.select("id", "k", "k2").join(classes.select("k", "k2", "c", "links", "component_id"), ["k", "k2"], "left")
    return out.select(F.col("id").alias(id_col),
                      F.coalesce(F.col("c") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce("component_id", "id").alias("component_id"),
                      F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(True)).alias("kept"))


def linked(found: DataFrame, index: Index, threshold: float) -> DataFrame:
    """Links between distinct vectors (id, v, c): rows (id, links) that count the
    vectors linked, and rows (id, other) with ``edge`` that connect them."""
    placed = checkpoint(found.mapInPandas(_place(index), "id long, v array<double>, c long, home int, seen array<int>"))
    # blocks of each cell's entries and visitors, from their counts
    n_own = placed.groupBy(F.col("home").alias("cell")).agg(F.count("*").alias("n_own"))
    n_all = placed.select(F.explode("seen").alias("cell")).groupBy("cell").agg(F.count("*").alias("n_guest"))
    size = checkpoint(n_own.join(n_all, "cell").select(
        "cell", F.ceil(F.col("n_own") / BLOCK).cast("int").alias("bo"), F.ceil(F.col("n_guest") / BLOCK).cast("int").alias("bg")))
    own = F.pmod(F.xxhash64("id"), F.col("bo")).cast("int").alias("x")
    come = F.pmod(F.xxhash64("id"), F.col("bg")).cast("int").alias("y")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    entry = (placed.withColumn("cell", F.col("home")).join(size, "cell")
             .select("cell", F.lit(True).alias("entry"), "id", "v", "c", "home", "seen", own, every("bg").alias("y")))
    guest = (placed.select("id", "v", "c", "home", F.explode("seen").alias("cell")).join(size, "cell")
             .select("cell", F.lit(False).alias("entry"), "id", "v", "c", "home",
                     F.array().cast("array<int>").alias("seen"), every("bo").alias("x"), "bg")
             .select("cell", "entry", "id", "v", "c", "home", "seen", "x", come))
    return checkpoint(entry.unionByName(guest).groupBy("cell", "x", "y").applyInPandas(
        _compare(threshold), "id long, links long, other long, edge boolean"))
