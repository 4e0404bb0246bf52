"""Approximate nearest neighbours by largest inner product, with a hierarchical
navigable small-world graph per shard.

Rows are dealt by the hash of their id into shards of about ``SHARD_ROWS`` rows
of one length.  A shard's vectors get one more component that makes all of them
equally long, so that the nearest by angle is the one with the largest inner
product, for any query (whose added component is zero).  Equal vectors of a
shard are one node, which keeps the smallest ``k + 1`` of its ids: no more can be
among a query's ``k`` nearest.

Each node is drawn a top layer; nodes are numbered from the highest layer down,
so a layer is a prefix of them and its graph one flat array of neighbour numbers
with a fixed number of places a node.  A layer is filled in batches that grow
with it: a batch is searched in what is linked so far and compared with itself,
neighbours are chosen so that none is nearer to another chosen one than to the
node, and links are made both ways and thinned by the same rule.  Search walks
down the layers and keeps the best ``ef`` places on the last one, for a block of
queries at once.  ``ef`` is not fixed: a task compares some of its queries with
the whole shard and doubles ``ef`` until the graph finds ``RECALL`` of their
nearest; at the number of nodes all that links reach is visited.

Graphs are written as a table, one row a shard.  Every block of queries meets
every shard of its length; a task holds one graph and one block.  Scores are
computed again in double precision on the original vectors, then merged over
shards in two steps.

Defined results: vectors that are null, zero, empty or hold null or non-finite
components take no part, nor do rows with a null id; vectors are compared with
those of their own length; of rows with one id that with the smallest vector
counts; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspark.session import scratch_path

SHARD_ROWS, SHARD_VALUES = 8_192, 4_000_000  # rows of a shard, about, and numbers in them
LINKS = 16  # of a node in a layer; twice that in the lowest
WIDTH = 64  # places kept while a node is inserted
EF = 64  # and while a query is answered, at first
RECALL, TRIED = 0.96, 96  # of the nearest in a shard, measured on so many of a task's queries
STEP = 4  # places of a search expanded together, or a 32nd of those kept
BLOCK = 256  # searches side by side
QUERIES = 4_096  # in a task
FIRST = 128  # nodes linked by comparing all of them
TASKS = 20_000  # at most, for shards or for blocks of queries
MERGE = 64  # shards merged in the first step


@dataclass
class Graph:
    """``vectors`` of the nodes; per layer, from the lowest, the neighbours of
    its nodes as a flat array with -1 for free places; ``ids`` of node i at
    ``starts[i]`` to ``starts[i + 1]``."""
    vectors: np.ndarray
    layers: list[np.ndarray]
    sizes: list[int]
    ids: np.ndarray
    starts: np.ndarray

    def places(self, layer: int) -> np.ndarray:
        return self.layers[layer].reshape(self.sizes[layer], -1)


def lengthened(x: np.ndarray) -> np.ndarray:
    """Scaled to a longest vector of 1, with the component that makes all 1."""
    x = x / np.abs(x).max()
    x = x / np.sqrt((x * x).sum(1).max())
    return np.c_[x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))].astype(np.float32)


def walk(x: np.ndarray, near: np.ndarray, q: np.ndarray, entry: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` best places found for each query from its entries (queries x
    entries), best first, as (nodes, inner products); -1 where there are fewer."""
    n, m = len(near), len(q)
    seen = np.zeros(m * n, bool)
    mark = np.zeros(m * n, np.int32)
    node = np.full((m, ef), -1, np.int64)
    value = np.full((m, ef), -np.inf, np.float32)
    done = np.ones((m, ef), bool)
    step = max(STEP, ef // 32)
    rows, new = np.repeat(np.arange(m), entry.shape[1]), entry.ravel()
    while True:
        code = rows * n + new
        mark[code] = np.arange(len(code))
        once = (mark[code] == np.arange(len(code))) & ~seen[code]
        rows, new, code = rows[once], new[once], code[once]
        seen[code] = True
        if len(rows):
            by = np.argsort(rows, kind="stable")
            rows, new = rows[by], new[by]
            count = np.bincount(rows, minlength=m)
            column = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
            found = np.full((m, int(count.max())), -np.inf, np.float32)
            named = np.full(found.shape, -1, np.int64)
            found[rows, column] = np.einsum("ij,ij->i", q[rows], x[new])
            named[rows, column] = new
            value, node = np.c_[value, found], np.c_[node, named]
            done = np.c_[done, named < 0]
            best = np.argsort(-value, axis=1, kind="stable")[:, :ef]
            value, node, done = (np.take_along_axis(a, best, 1) for a in (value, node, done))
        open_ = ~done
        pick = open_ & (np.cumsum(open_, axis=1) <= step)
        rows, at = np.nonzero(pick)
        if not len(rows):
            return node, value
        done |= pick
        nxt = near[node[rows, at]]
        rows, new = np.repeat(rows, nxt.shape[1]), nxt.ravel()
        rows, new = rows[new >= 0], new[new >= 0]


def chosen(x: np.ndarray, who: np.ndarray, cand: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """For each node up to ``most`` of its candidates (best first, -1 for none):
    those nearer to it than to any chosen before, then the best of the rest."""
    out = np.full((len(who), most), -1, np.int64)
    for lo in range(0, len(who), BLOCK):
        c, v = cand[lo:lo + BLOCK], value[lo:lo + BLOCK]
        y = x[np.maximum(c, 0)]
        between = y @ y.transpose(0, 2, 1)
        keep = np.zeros(c.shape, bool)
        for j in range(c.shape[1]):
            nearest = np.where(keep[:, :j], between[:, j, :j], -np.inf).max(axis=1, initial=-np.inf)
            keep[:, j] = (c[:, j] >= 0) & (keep.sum(1) < most) & (v[:, j] > nearest)
        # chosen ones first, then the others, each best first
        order = np.argsort(np.where(keep, 0, np.where(c >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        part = np.take_along_axis(c, order, 1)
        out[lo:lo + BLOCK, :part.shape[1]] = part
    return out


def ranked(x: np.ndarray, who: np.ndarray, cand: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates of each node by inner product, without itself and repeats."""
    value = np.einsum("ij,ikj->ik", x[who], x[np.maximum(cand, 0)])
    order = np.argsort(cand, axis=1, kind="stable")
    sorted_ = np.take_along_axis(cand, order, 1)
    repeat = np.zeros(cand.shape, bool)
    np.put_along_axis(repeat, order, np.c_[np.zeros(len(cand), bool), sorted_[:, 1:] == sorted_[:, :-1]], 1)
    gone = repeat | (cand < 0) | (cand == who[:, None])
    value, cand = np.where(gone, -np.inf, value), np.where(gone, -1, cand)
    order = np.argsort(-value, axis=1, kind="stable")
    return np.take_along_axis(cand, order, 1), np.take_along_axis(value, order, 1)


def link(x: np.ndarray, near: np.ndarray, who: np.ndarray, cand: np.ndarray, value: np.ndarray) -> None:
    """Link new nodes with chosen candidates, both ways."""
    places = near.shape[1]
    near[who] = chosen(x, who, cand, value, places)
    rows, at = np.nonzero(near[who] >= 0)
    to, back = near[who][rows, at], who[rows]
    order = np.argsort(to, kind="stable")
    to, back = to[order], back[order]
    target, first, count = np.unique(to, return_index=True, return_counts=True)
    for lo in range(0, len(target), BLOCK):
        t, c = target[lo:lo + BLOCK], count[lo:lo + BLOCK]
        more = np.full((len(t), int(c.max())), -1, np.int64)
        at = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        more[np.repeat(np.arange(len(t)), c), at] = back[first[lo]:first[lo] + c.sum()]
        both, worth = ranked(x, t, np.c_[near[t], more])
        near[t] = chosen(x, t, both, worth, places)


def layer(x: np.ndarray, n: int, places: int, above: list[np.ndarray]) -> np.ndarray:
    """Neighbours of the first ``n`` nodes among themselves."""
    near = np.full((n, places), -1, np.int64)
    done = min(n, FIRST)
    who = np.arange(done)
    if done > 1:
        cand, value = ranked(x, who, np.repeat(who[None], done, 0))
        near[who] = chosen(x, who, cand[:, :WIDTH], value[:, :WIDTH], places)
    while done < n:
        who = np.arange(done, min(n, done + max(FIRST, min(done // 2, 4 * BLOCK))))
        old = np.concatenate([walk(x, near[:done], x[w], descend(x, above, x[w], done), WIDTH)[0]
                              for w in np.array_split(who, -(-len(who) // BLOCK))])
        own = x[who] @ x[who].T
        np.fill_diagonal(own, -np.inf)
        mates = np.argsort(-own, axis=1, kind="stable")[:, :WIDTH // 2] + done
        cand, value = ranked(x, who, np.c_[old, np.where(mates == who[:, None], -1, mates)])
        link(x, near, who, cand[:, :WIDTH], value[:, :WIDTH])
        done += len(who)
    return near


def descend(x: np.ndarray, above: list[np.ndarray], q: np.ndarray, below: int) -> np.ndarray:
    """Entries for a layer: the best places of the layers above, from the top."""
    entry = np.zeros((len(q), 1), np.int64)
    for near in reversed(above):
        entry = walk(x, near, q, entry, STEP)[0]
        entry = np.where(entry < 0, entry[:, :1], entry)
    return np.where(entry < below, entry, 0)


def build(ids: np.ndarray, vectors: np.ndarray, keep: int) -> Graph:
    """The graph of a shard; ``keep`` ids of equal vectors stay."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order]) + 0.0
    _, first, node = np.unique(vectors.view(f"V{vectors.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
    n = len(first)
    top = np.floor(-np.log(1 - np.random.default_rng(23).random(n)) / np.log(LINKS)).astype(int)
    place = np.argsort(-top, kind="stable")
    rank = np.empty(n, np.int64)
    rank[place] = np.arange(n)
    vectors, node = vectors[first][place], rank[node]
    by = np.argsort(node, kind="stable")  # ids of a node stay in order
    count = np.bincount(node, minlength=n)
    nth = np.arange(len(by)) - np.repeat(np.cumsum(count) - count, count)
    x = lengthened(vectors)
    above = []  # from the lowest of them
    for t in range(int(top.max()), -1, -1):
        size = int((top >= t).sum())
        above.insert(0, layer(x, size, LINKS * (1 if t else 2), above))
    return Graph(vectors, [a.astype(np.int32).ravel() for a in above], [len(a) for a in above], ids[by][nth < keep],
                 np.r_[0, np.cumsum(np.minimum(count, keep))])


def wide_enough(x: np.ndarray, near: list[np.ndarray], q: np.ndarray, k: int, recall: float) -> int:
    """The first of EF, 2 EF, ... that finds ``recall`` of the ``k`` nearest nodes
    of all queries together, and 0.9 of the best one alone."""
    k, ef = min(k, len(x)), EF
    entry = descend(x, near[1:], q, len(x))
    true = np.sort(q @ x.T, axis=1)[:, ::-1][:, :k] - 1e-5
    while ef < len(x):
        _, value = walk(x, near[0], q, entry, ef)
        found = value[:, :k]
        if (found >= true[:, k - 1:]).mean() >= recall and (found[:, 0] >= true[:, 0]).mean() >= 0.9:
            break
        ef *= 2
    return min(ef, len(x))


def search(g: Graph, ids: np.ndarray, queries: np.ndarray, k: int, recall: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, id, inner product) of up to ``k`` nearest of each."""
    x = lengthened(g.vectors)
    top = np.abs(queries).max(axis=1, keepdims=True)
    q = np.c_[queries / top, np.zeros(len(queries))]
    q = (q / np.sqrt((q * q).sum(1))[:, None]).astype(np.float32)
    near = [g.places(t).astype(np.int64) for t in range(len(g.sizes))]
    some = np.linspace(0, len(q) - 1, min(TRIED, len(q))).astype(int)
    ef = max(min(k + 1, len(x)), wide_enough(x, near, q[some], k, recall))
    out = []
    for lo in range(0, len(q), BLOCK):
        part = q[lo:lo + BLOCK]
        found, _ = walk(x, near[0], part, descend(x, near[1:], part, len(x)), ef)
        rows, at = np.nonzero(found >= 0)
        node = found[rows, at]
        score = (queries[rows + lo] * g.vectors[node]).sum(axis=1)
        size = np.diff(g.starts)[node]
        other = g.ids[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(g.starts[node], size)]
        rows, score = np.repeat(rows, size) + lo, np.repeat(score, size)
        own = other != ids[rows]
        rows, other, score = rows[own], other[own], score[own]
        order = np.lexsort((other, -score, rows))
        rows, other, score = rows[order], other[order], score[order]
        nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
        out.append((rows[nth < k], other[nth < k], score[nth < k]))
    return tuple(np.concatenate(c) for c in zip(*out))


GRAPH = "width int, shard int, vectors binary, layers array<binary>, sizes array<int>, ids binary, starts binary"


def _build(keep: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        g = build(rows["id"].to_numpy(np.int64), np.array(rows["v"].tolist(), float), keep)
        return pd.DataFrame({"width": rows["width"].iloc[:1].values, "shard": rows["shard"].iloc[:1].values,
                             "vectors": [g.vectors.tobytes()], "layers": [[a.tobytes() for a in g.layers]], "sizes": [g.sizes],
                             "ids": [g.ids.tobytes()], "starts": [g.starts.tobytes()]})
    return run


def _search(k: int, recall: float):
    def run(graphs: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(graphs) or not len(queries):
            return pd.DataFrame({"query_id": [], "part": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "part": "int32", "vec_id": "int64", "score": "float64"})
        r = graphs.iloc[0]
        g = Graph(np.frombuffer(r["vectors"]).reshape(-1, r["width"]), [np.frombuffer(a, np.int32) for a in r["layers"]],
                  [int(s) for s in r["sizes"]], np.frombuffer(r["ids"], np.int64), np.frombuffer(r["starts"], np.int64))
        ids = queries["id"].to_numpy(np.int64)
        rows, other, score = search(g, ids, np.array(queries["v"].tolist(), float), k, recall)
        return pd.DataFrame({"query_id": ids[rows], "part": np.int32(r["shard"] // MERGE), "vec_id": other, "score": score})
    return run


def fine_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, width) of the vectors that take part, one row an id."""
    src = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda t: t.isNotNull() & ~F.isnan(t) & (F.abs(t) < float("inf"))) & F.exists("v", lambda t: t != 0)
    return (src.where(F.col("id").isNotNull() & F.col("v").isNotNull()).where(fine)
            .groupBy("id").agg(F.min("v").alias("v")).withColumn("width", F.size("v")))


def neighbours(rows: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
               shard_rows: int = SHARD_ROWS, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest of every row whose id is divisible by ``every``:
    query_id, rank, vec_id, score."""
    spark = rows.sparkSession
    base = scratch_path(spark, f"hnsw-{uuid.uuid4().hex}")
    items = fine_vectors(rows, id_col, vector_col)
    items.write.parquet(f"{base}/items")
    items = spark.read.parquet(f"{base}/items")
    # shards and query blocks of each length, from their counts
    size = items.groupBy("width").agg(F.count("*").alias("n"), F.count_if(F.col("id") % every == 0).alias("nq"))
    per = F.least(F.lit(shard_rows), F.greatest(F.lit(1), F.floor(F.lit(SHARD_VALUES) / F.col("width"))))
    size = size.select("width", F.ceil(F.col("n") / per).cast("int").alias("shards"),
                       F.ceil(F.col("nq") / QUERIES).cast("int").alias("blocks"))
    dealt = items.join(size, "width").withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))
    # little data but much work: as many tasks as groups, whatever their bytes
    groups = size.agg(F.sum("shards").alias("build"), F.sum(F.col("shards").cast("long") * F.col("blocks")).alias("search")).first()
    n_build, n_search = (max(1, min(TASKS, 2 * (n or 0))) for n in groups)
    (dealt.select("width", "shard", "id", "v").repartition(n_build, "width", "shard").groupBy("width", "shard")
     .applyInPandas(_build(k + 1), GRAPH).write.parquet(f"{base}/graphs"))
    count = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    graphs = spark.read.parquet(f"{base}/graphs").join(size.where("blocks > 0"), "width").withColumn("block", count("blocks"))
    queries = (items.where(F.col("id") % every == 0).join(size, "width")
               .withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")).withColumn("shard", count("shards")))
    key = ["width", "shard", "block"]
    found = (graphs.drop("shards", "blocks").repartition(n_search, *key).groupBy(*key)
             .cogroup(queries.select(*key, "id", "v").repartition(n_search, *key).groupBy(*key))
             .applyInPandas(_search(k, recall), "query_id long, part int, vec_id long, score double"))
    order = [F.desc("score"), F.asc("vec_id")]
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "part").orderBy(*order))).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order))).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")
