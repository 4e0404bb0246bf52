"""Boosted trees for several classes: softmax loss, binned features.

A round grows one tree a class, all of them level by level together.  For a
level, one pass over the binned rows adds up gradients and second derivatives
per class, node, feature and bin; Spark sums them over the tasks, and the driver
picks the splits from these sums, whose number depends on the settings and never
on the rows.  Gradients are rounded to 2^-20 and summed as whole numbers, so the
trees do not depend on how rows are dealt to tasks.  Where the sample shows that
many rows are alike in all bins, rows of one label and the same bins are kept as
one row and their number; whole sums are the same.  If what is left is small
(``HELD`` bytes), it is added up on the driver, without a job a level: by the same
function, to the same sums.

Bin edges are quantiles of a bounded sample (``SAMPLE`` rows with the smallest
hashes); every row counts in every sum.  A missing number (NaN) has a bin of its
own, and each split sends it to the better side.  Rows without a label or
features are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.operators.manykmeans import as_array
from wellspark.operators.requests import _param, _Stage

SAMPLE = 16_384  # rows that bin edges are taken from
BINS = 64  # at most 254, as a bin is one byte and 0 stands for a missing number
CELLS = 2_000_000  # sums read back at a time; wider levels are taken in parts of their nodes
ALIKE = 0.5  # share of different rows in the sample up to which rows alike in all bins are counted together
HELD = 8_000_000  # bytes of bins and margins up to which rows are added up on the driver
KEPT = 10  # rounds after which the rows' margins are stored anew
WHOLE = float(1 << 20)  # gradients are counted in units of its inverse


def bin_edges(x: np.ndarray, bins: int) -> list[list[float]]:
    """Ascending edges of every column; a number is in the bin after the last
    edge that it reaches.  Few different numbers are parted in their middles."""
    out = []
    for col in x.T:
        seen = np.unique(col[np.isfinite(col)])
        if len(seen) <= bins:
            edges = seen[:-1] + (seen[1:] - seen[:-1]) / 2
        else:
            edges = np.unique(np.quantile(col[np.isfinite(col)], np.arange(1, bins) / bins))
        out.append([float(e) for e in edges])
    return out


def to_bins(x: np.ndarray, edges: list[list[float]]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, e in enumerate(edges):
        out[:, j] = np.where(np.isnan(x[:, j]), 0, np.searchsorted(np.array(e, float), x[:, j], side="right") + 1)
    return out


def leaves(bins: np.ndarray, tree: dict[str, np.ndarray], depth: int) -> np.ndarray:
    """The node of every row in one tree after ``depth`` levels (children of
    node i: 2i + 1 and 2i + 2; ``feature`` -1: no split)."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        f = tree["feature"][at]
        b = bins[rows, np.maximum(f, 0)]
        left = np.where(b == 0, tree["missing_left"][at], b <= tree["cut"][at])
        at = np.where(f < 0, at, 2 * at + 2 - left)
    return at


def add_margins(margin: np.ndarray, bins: np.ndarray, rounds: list[list[dict]], depth: int) -> np.ndarray:
    """Margins of the classes plus the values of every round's trees."""
    out = margin.copy()
    for trees in rounds:
        for c, tree in enumerate(trees):
            out[:, c] += tree["value"][leaves(bins, tree, depth)]
    return out


def softmax(margin: np.ndarray) -> np.ndarray:
    e = np.exp(margin - margin.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def best_splits(g: np.ndarray, h: np.ndarray, lam: float, least: float) -> dict[str, np.ndarray]:
    """The best split of every node from its sums (node, feature, bin); ties go
    to the first feature, then the first cut, then missing numbers left."""
    G, H = g[:, :1].sum(2, keepdims=True), h[:, :1].sum(2, keepdims=True)
    gl, hl = np.cumsum(g[:, :, 1:], 2)[:, :, :-1], np.cumsum(h[:, :, 1:], 2)[:, :, :-1]
    gl = np.stack([gl + g[:, :, :1], gl], -1)  # missing numbers left, right
    hl = np.stack([hl + h[:, :, :1], hl], -1)
    G, H = G[..., None], H[..., None]
    gain = gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam)
    gain = np.where((hl >= least) & (H - hl >= least), gain, -np.inf)
    flat = gain.reshape(len(g), -1)
    at = flat.argmax(1)
    f, cut, right = np.unravel_index(at, gain.shape[1:])
    n = np.arange(len(g))
    gl, hl, G, H = gl[n, f, cut, right], hl[n, f, cut, right], G[:, 0, 0, 0], H[:, 0, 0, 0]
    return {"split": flat[n, at] > 1e-6, "feature": f, "cut": cut + 1, "missing_left": right == 0,
            "left": -gl / (hl + lam), "right": -(G - gl) / (H - hl + lam), "own": -G / (H + lam)}


def _matrix(col: pd.Series, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), kind).reshape(-1, width)


class Held:
    """Binned rows small enough for one place, with margins of all rounds so far."""

    def __init__(self, rows: pd.DataFrame, width: int, classes: int):
        self.x, self.y, self.n = _matrix(rows["bins"], np.uint8, width), rows["y"].to_numpy(), rows["n"].to_numpy()
        self.margin = np.zeros((len(rows), classes))

    def count(self) -> int:
        return len(self.y)

    def advance(self, trees: list[dict], depth: int) -> None:
        self.margin = add_margins(self.margin, self.x, [trees], depth)


def _sums(data: DataFrame | Held, rounds, trees, level: int, part: np.ndarray, weights: np.ndarray, depth: int, width: int, bins: int):
    """Sums of the level's nodes ``part`` (class and node numbers as c * 2^level + i)."""
    classes, cells = len(weights), width * (bins + 1)
    place = np.full(classes << level, -1)
    place[part] = np.arange(len(part))

    def add(total, x, y, n, margin):
        p = softmax(add_margins(margin, x, rounds, depth))
        for c in range(classes):
            w = weights[y]
            g = np.rint(w * (p[:, c] - (y == c)) * WHOLE) * n
            h = np.rint(w * 2 * p[:, c] * (1 - p[:, c]) * WHOLE) * n
            node = leaves(x, trees[c], level) - ((1 << level) - 1)
            node = np.where(node >= 0, place[(c << level) + np.maximum(node, 0)], -1)
            own = np.flatnonzero(node >= 0)
            for f in range(width):
                cell = node[own] * cells + f * (bins + 1) + x[own, f]
                total[0] += np.bincount(cell, g[own], total.shape[1]).astype(np.int64)
                total[1] += np.bincount(cell, h[own], total.shape[1]).astype(np.int64)

    def run(batches):
        total = np.zeros((2, len(part) * cells), np.int64)
        for b in batches:
            if len(b):
                add(total, _matrix(b["bins"], np.uint8, width), b["y"].to_numpy(), b["n"].to_numpy(), _matrix(b["margin"], np.float64, classes))
        some = np.flatnonzero(total.any(0))
        yield pd.DataFrame({"cell": some, "g": total[0, some], "h": total[1, some]})

    if isinstance(data, Held):
        whole = np.zeros((2, len(part) * cells), np.int64)
        add(whole, data.x, data.y, data.n, data.margin)
        return (whole / WHOLE).reshape(2, len(part), width, bins + 1)
    got = data.mapInPandas(run, "cell long, g long, h long").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toPandas()
    out = np.zeros((2, len(part) * cells))
    at = got["cell"].to_numpy(np.int64)
    out[0, at], out[1, at] = got["g"].to_numpy() / WHOLE, got["h"].to_numpy() / WHOLE
    return out.reshape(2, len(part), width, bins + 1)


def _grow(data, rounds, weights, depth, width, bins, step, lam, least) -> list[dict]:
    classes, nodes = len(weights), (2 << depth) - 1
    trees = [{"feature": np.full(nodes, -1), "cut": np.zeros(nodes, np.int64), "missing_left": np.zeros(nodes, bool),
              "value": np.zeros(nodes)} for _ in range(classes)]
    live = np.arange(classes)  # c * 2^level + i of the nodes that may still split
    for level in range(depth):
        most = max(1, CELLS // (width * (bins + 1)))
        nxt = []
        for lo in range(0, len(live), most):
            part = live[lo:lo + most]
            s = best_splits(*_sums(data, rounds, trees, level, part, weights, depth, width, bins), lam, least)
            for n, (c, i) in enumerate(zip(part >> level, part & ((1 << level) - 1))):
                t, at = trees[c], (1 << level) - 1 + i
                t["value"][at] = step * s["own"][n]
                if s["split"][n]:
                    t["feature"][at], t["cut"][at], t["missing_left"][at] = s["feature"][n], s["cut"][n], s["missing_left"][n]
                    t["value"][2 * at + 1], t["value"][2 * at + 2] = step * s["left"][n], step * s["right"][n]
                    nxt += [(c << (level + 1)) + 2 * i, (c << (level + 1)) + 2 * i + 1]
        live = np.array(sorted(nxt), np.int64)
        if not len(live):
            break
    return trees


class BoostedClasses(_Stage, Transformer):
    """``probability`` (a vector, summing to 1) and ``prediction`` (the likeliest
    class, ties: the smallest).  Rows without features get nulls."""

    trees = _param("trees", "per round and class: feature, cut, missing_left, value of every node")
    edges = _param("edges", "bin edges of every feature")
    classes = _param("classes", "number of classes")
    depth = _param("depth", "levels of a tree")
    features = _param("features", "vector or array column")

    @keyword_only
    def __init__(self, *, trees=None, edges=None, classes=None, depth=None, features=None):
        super().__init__()
        self._setDefault(features="features")
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        edges, classes, depth = self.given("edges"), self.given("classes"), self.given("depth")
        rounds = [[{k: np.array(v) for k, v in t.items()} for t in r] for r in self.given("trees")]

        @F.pandas_udf("array<double>")
        def probabilities(v: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(v), dtype=object)
            some = np.flatnonzero(v.notna().to_numpy())
            if len(some):
                x = to_bins(np.array(v.iloc[some].tolist(), float), edges) if edges else np.zeros((len(some), 0), np.uint8)
                for i, p in zip(some, softmax(add_margins(np.zeros((len(some), classes)), x, rounds, depth))):
                    out.iat[i] = p
            return out

        kept = df.withColumn("_p", probabilities(as_array(df, self.given("features"))))
        return kept.withColumn("probability", F.when(F.col("_p").isNotNull(), array_to_vector("_p"))) \
            .withColumn("prediction", (F.array_position("_p", F.array_max("_p")) - 1).cast("double")).drop("_p")


def fit_softmax(train: DataFrame, classes: int, features: str = "features", label: str = "label", rounds: int = 50,
                step: float = 0.3, depth: int = 6, balanced: bool = True, lam: float = 1.0, least: float = 1.0,
                bins: int = BINS) -> BoostedClasses:
    """Trees for labels 0 .. ``classes`` - 1; ``balanced`` weighs a row by
    n / (classes seen * rows of its class).  Without rows every class is as
    likely as the others; another label raises ``ValueError``."""
    rows = train.select(as_array(train, features).alias("v"), F.col(label).alias("y")).where("v IS NOT NULL AND y IS NOT NULL")
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).limit(classes + 1).collect()}
    if any(y not in range(classes) for y in counts):
        raise ValueError(f"labels must be whole numbers from 0 to {classes - 1}")
    sample = np.array([r["v"] for r in rows.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).select("v").collect()], float)
    if not len(sample):
        return BoostedClasses(trees=[], edges=[], classes=classes, depth=depth, features=features)
    width, n = sample.shape[1], sum(counts.values())
    edges = bin_edges(sample, bins)
    weights = np.array([n / (len(counts) * counts[c]) if balanced and c in counts else 1.0 for c in range(classes)])

    def binned(batches):
        for b in batches:
            x = to_bins(np.array(b["v"].tolist(), float).reshape(-1, width), edges)
            yield pd.DataFrame({"y": b["y"].astype("int64"), "bins": [r.tobytes() for r in x], "margin": [bytes(8 * classes)] * len(x)})

    def advanced(rounds):
        def run(batches):
            for b in batches:
                m = add_margins(_matrix(b["margin"], np.float64, classes), _matrix(b["bins"], np.uint8, width), rounds, depth)
                yield b.assign(margin=[r.tobytes() for r in m])
        return run

    schema = "y long, bins binary, margin binary, n long"
    data = rows.mapInPandas(binned, "y long, bins binary, margin binary")
    seen = to_bins(sample, edges)
    if len(np.unique(seen, axis=0)) <= ALIKE * len(seen):  # rows alike in all bins are one row that counts n times
        data = data.groupBy("y", "bins", "margin").agg(F.count(F.lit(1)).alias("n"))
    else:
        data = data.withColumn("n", F.lit(1).cast("long"))
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    done, kept = [], 0
    try:
        if data.count() * (width + 8 * classes) <= HELD:
            held = Held(data.drop("margin").toPandas(), width, classes)
            for _ in range(rounds):
                done.append(_grow(held, [], weights, depth, width, bins, step, lam, least))
                held.advance(done[-1], depth)
        for _ in range(rounds - len(done)):
            if len(done) - kept == KEPT:
                old, data = data, data.mapInPandas(advanced(done[kept:]), schema).persist(StorageLevel.MEMORY_AND_DISK)
                data.count()
                old.unpersist()
                kept = len(done)
            done.append(_grow(data, done[kept:], weights, depth, width, bins, step, lam, least))
    finally:
        data.unpersist()
    plain = [[{k: v.tolist() for k, v in t.items()} for t in r] for r in done]
    return BoostedClasses(trees=plain, edges=edges, classes=classes, depth=depth, features=features)
