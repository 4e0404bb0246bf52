"""Many k-means fits over one scan an iteration.

All starts of all K are fitted together: a pass tries each block of rows against
the centres of every fit, and counts, sums and squared distances of all centres
leave a task as one row a centre, to be added up in Spark.  So the input is read
(from the cache) once an iteration whatever the number of fits, and the driver
holds the centres and their sums, never rows.  Fits that have settled leave.

Most rows keep their centres from pass to pass.  A reference pass therefore keeps
each row's nearest centre of every fit and by how much the second nearest is
farther.  While the centres have moved by less than that since, the row stays
(triangle inequality), and a pass computes distances only for the other rows and
adds up what changed.  Once these passes have cost as much as a full one, the
next is a reference pass again.  The centres are those of plain passes, but for
the rounding of sums.

Starts are drawn by distance (k-means++) from a bounded sample of rows, those
with the smallest hashes, and first settle on that sample in memory, which saves
most passes; they then settle on all rows.  Rows without a vector are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.operators.requests import _param, _Stage

SAMPLE = 4_096  # rows that starts are drawn from
ROWS, CELLS = 4_096, 4_000_000  # rows multiplied at a time, and products of them with centres
STACK = 1_000_000  # numbers in the stacked centres; more fits are taken in turn


@dataclass
class Fit:
    k: int
    start: int
    centres: np.ndarray
    inertia: float = float("inf")
    passes: int = 0
    measured: np.ndarray | None = None  # the centres of the last pass


def as_array(df: DataFrame, features: str) -> "F.Column":
    from pyspark.ml.functions import vector_to_array
    kind = df.schema[features].dataType.typeName()
    return vector_to_array(features) if kind == "vectorudt" else F.col(features).cast("array<double>")


def plus_plus(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k rows, each drawn with the squared distance to the nearest before."""
    at = [int(rng.integers(len(x)))]
    near = ((x - x[at[0]]) ** 2).sum(1)
    while len(at) < k:
        total = near.sum()
        at.append(int(rng.choice(len(x), p=near / total)) if total > 0 else int(rng.integers(len(x))))
        near = np.minimum(near, ((x - x[at[-1]]) ** 2).sum(1))
    return x[at].copy()


def _steps(x: np.ndarray, k: int):
    step = max(1, min(ROWS, CELLS // k))
    return (x[lo:lo + step] for lo in range(0, len(x), step))


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of every row (ties: the first) and the squared distance."""
    half = (centres * centres).sum(1) / 2
    who, near = [np.zeros(0, np.int64)], [np.zeros(0)]
    for y in _steps(x, len(centres)):
        gap = half - y @ centres.T
        w = gap.argmin(1)
        who.append(w)
        near.append(np.maximum(2 * gap[np.arange(len(y)), w] + (y * y).sum(1), 0))
    return np.concatenate(who), np.concatenate(near)


def two_nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre, and by how much every other is farther at least."""
    if len(centres) == 1:
        return np.zeros(len(x), np.int64), np.full(len(x), np.inf, np.float32)
    half = (centres * centres).sum(1) / 2
    who, room = [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for y in _steps(x, len(centres)):
        gap, rows, own = half - y @ centres.T, np.arange(len(y)), (y * y).sum(1)
        w = gap.argmin(1)
        first = gap[rows, w]
        gap[rows, w] = np.inf
        second = gap.min(1)
        far = np.sqrt(np.maximum(2 * first + own, 0)) + np.sqrt(np.maximum(2 * second + own, 0))
        error = 8 * (x.shape[1] + 4) * np.finfo(float).eps * (own + 2 * half.max())
        who.append(w)
        with np.errstate(invalid="ignore", divide="ignore"):
            apart = (2 * (second - first) - error) / far
        room.append(np.where(apart > 0, apart * (1 - 1e-6), 0).astype(np.float32))
    return np.concatenate(who), np.concatenate(room)


def _added(who: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Sum of the rows of every centre."""
    total = np.zeros((k, x.shape[1]))
    step = max(1, min(ROWS, CELLS // k))
    for lo in range(0, len(x), step):
        total += (who[None, lo:lo + step] == np.arange(k)[:, None]).astype(float) @ x[lo:lo + step]
    return total


def sums(blocks, centres: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per centre of the stack: rows nearest to it within its fit, their squared
    distances and their sum."""
    n, cost, total = np.zeros(len(centres)), np.zeros(len(centres)), np.zeros(centres.shape)
    for x in blocks:
        for a, z in zip(firsts[:-1], firsts[1:]):
            who, near = nearest(x, centres[a:z])
            n[a:z] += np.bincount(who, minlength=z - a)
            cost[a:z] += np.bincount(who, near, z - a)
            total[a:z] += _added(who, x, z - a)
    return n, cost, total


def stacked(fits: list[Fit]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([f.centres for f in fits]), np.cumsum([0, *(f.k for f in fits)])


def _matrix(col: pd.Series, d: int) -> np.ndarray:
    return np.array(col.tolist(), float).reshape(-1, d)


def _sent(firsts: np.ndarray, n: np.ndarray, cost: np.ndarray, total: np.ndarray) -> pd.DataFrame:
    """A row a fit: its counts, costs and sums."""
    whole = np.column_stack([n, cost, total])
    some = [f for f, (a, z) in enumerate(zip(firsts[:-1], firsts[1:])) if whole[a:z].any()]
    return pd.DataFrame({"f": np.array(some, np.int32), "s": [whole[firsts[f]:firsts[f + 1]].tobytes() for f in some]})


def _added_up(parts: DataFrame, shape: tuple[int, int], firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tasks' rows of each fit added up in Spark."""
    def add(batches):
        total = {}
        for b in batches:
            for f, s in zip(b["f"], b["s"]):
                x = np.frombuffer(s)
                total[f] = total[f] + x if f in total else x
        yield pd.DataFrame({"f": np.array(list(total), np.int32), "s": [x.tobytes() for x in total.values()]})

    tasks = min(len(firsts) - 1, parts.sparkSession.sparkContext.defaultParallelism)
    got = parts.repartition(tasks, "f").mapInPandas(add, "f int, s binary").toPandas()
    out = np.zeros((shape[0], shape[1] + 2))
    for f, s in zip(got["f"], got["s"]):
        out[firsts[f]:firsts[f + 1]] = np.frombuffer(bytes(s)).reshape(-1, shape[1] + 2)
    return out[:, 0], out[:, 1], out[:, 2:]


def _pass(data: DataFrame, fits: list[Fit]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``sums`` over all rows: a row a fit and task, added up in Spark."""
    centres, firsts = stacked(fits)
    d = centres.shape[1]
    shared = data.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        yield _sent(firsts, *sums((_matrix(b["v"], d) for b in batches), shared.value, firsts))

    out = _added_up(data.mapInPandas(run, "f int, s binary"), centres.shape, firsts)
    shared.destroy()
    return out


class Passes:
    """Passes over all rows with a reference: ``who`` and ``room`` of every row
    and fit, kept beside the vectors.  A lost block is computed again from the
    vectors and the reference's centres."""

    def __init__(self, data: DataFrame):
        self.data, self.state, self.spent = data, None, 0.0

    def drop(self) -> None:
        if self.state is not None:
            self.state.unpersist()
            self.shared.destroy()
        self.state = None

    def refer(self, fits: list[Fit]) -> None:
        self.drop()
        centres, firsts = stacked(fits)
        d, spans = centres.shape[1], list(zip(firsts[:-1], firsts[1:]))
        kind = np.uint8 if max(f.k for f in fits) <= 256 else np.int32
        shared = self.data.sparkSession.sparkContext.broadcast(centres)

        def run(batches):
            for b in batches:
                x = _matrix(b["v"], d)
                found = [two_nearest(x, shared.value[a:z]) for a, z in spans]
                who, room = (np.stack([f[i] for f in found], axis=1).astype(t) for i, t in ((0, kind), (1, np.float32)))
                yield pd.DataFrame({"x": [r.tobytes() for r in x], "who": [r.tobytes() for r in who], "room": [r.tobytes() for r in room]})

        def counts(batches):
            n, total = np.zeros(len(shared.value)), np.zeros(shared.value.shape)
            for b in batches:
                x, who = (np.frombuffer(b"".join(b[c]), t).reshape(len(b), -1) for c, t in (("x", float), ("who", kind)))
                for j, (a, z) in enumerate(spans):
                    n[a:z] += np.bincount(who[:, j], minlength=z - a)
                    total[a:z] += _added(who[:, j], x, z - a)
            yield _sent(firsts, n, np.zeros(len(n)), total)

        self.state = self.data.mapInPandas(run, "x binary, who binary, room binary").persist()
        self.n, _, self.total = _added_up(self.state.mapInPandas(counts, "f int, s binary"), centres.shape, firsts)
        self.shared, self.centres, self.spans, self.kind, self.spent = shared, centres, spans, kind, 0.0
        self.place = {id(f): j for j, f in enumerate(fits)}

    def changes(self, fits: list[Fit]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What counts and sums of the reference have changed by, and the
        distances computed (as the cost of each fit's first centre)."""
        centres, firsts = stacked(fits)
        width, kind, spans = len(self.spans), self.kind, list(zip(firsts[:-1], firsts[1:]))
        places, limits = [self.place[id(f)] for f in fits], []
        for f, j in zip(fits, places):
            moved = np.sqrt(((f.centres - self.centres[slice(*self.spans[j])]) ** 2).sum(1))
            most = np.sort(moved)[::-1]
            others = np.where(moved == most[0], most[min(1, len(most) - 1)] if (moved == most[0]).sum() == 1 else most[0], most[0])
            limits.append((moved + others) * (1 + 1e-9) + 1e-12)
        shared = self.data.sparkSession.sparkContext.broadcast((centres, limits))

        def run(batches):
            now, limit = shared.value
            n, work, total = np.zeros(len(now)), np.zeros(len(now)), np.zeros(now.shape)
            for b in batches:
                x = np.frombuffer(b"".join(b["x"])).reshape(len(b), -1)
                who = np.ascontiguousarray(np.frombuffer(b"".join(b["who"]), kind).reshape(-1, width).T)
                room = np.ascontiguousarray(np.frombuffer(b"".join(b["room"]), np.float32).reshape(-1, width).T)
                for j, (a, z), most in zip(places, spans, limit):
                    at = np.flatnonzero(~(room[j] > most[who[j]]))
                    if z - a == 1 or not len(at):
                        continue
                    y, old = x[at], who[j][at]
                    new = nearest(y, now[a:z])[0]
                    work[a] += len(at) * (z - a)
                    ch = np.flatnonzero(new != old)
                    n[a:z] += np.bincount(new[ch], minlength=z - a) - np.bincount(old[ch], minlength=z - a)
                    total[a:z] += _added(new[ch], y[ch], z - a) - _added(old[ch], y[ch], z - a)
            yield _sent(firsts, n, work, total)

        out = _added_up(self.state.mapInPandas(run, "f int, s binary"), centres.shape, firsts)
        shared.destroy()
        return out

    def __call__(self, fits: list[Fit]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.state is None or self.spent > 1:
            self.refer(fits)
            return self.n, np.zeros(len(self.n)), self.total
        n, work, total = self.changes(fits)
        own = np.concatenate([np.arange(*self.spans[self.place[id(f)]]) for f in fits])
        self.spent += work.sum() / max(self.n[own].sum() / len(fits) * len(own), 1)
        return self.n[own] + n, np.zeros(len(own)), self.total[own] + total


def settle(fits: list[Fit], one_pass, least_move: float, max_iter: int) -> None:
    """Move the centres to the means of their rows until they stay."""
    live = list(fits)
    for _ in range(max_iter):
        if not live:
            break
        n, cost, total = one_pass(live)
        moved, a = [], 0
        for f in live:
            own = slice(a, a + f.k)
            f.inertia, f.passes, f.measured, a = float(cost[own].sum()), f.passes + 1, f.centres, a + f.k
            new = np.where(n[own, None] > 0, total[own] / np.maximum(n[own], 1)[:, None], f.centres)
            if ((new - f.centres) ** 2).sum() > least_move:
                f.centres = new
                moved.append(f)
        live = moved


def fit_many(df: DataFrame, ks, starts: int = 10, seed: int = 46, features: str = "features",
             max_iter: int = 300, tol: float = 1e-4) -> list[Fit]:
    """A settled fit for every k and start.  A fit has settled when its centres
    would move (squared, in all) by at most ``tol`` times the mean variance of
    the components; a centre that loses all rows stays where it is."""
    data = df.select(as_array(df, features).alias("v")).where("v IS NOT NULL").persist()
    try:
        some = data.orderBy(F.xxhash64("v"), "v").limit(SAMPLE).toPandas()["v"].tolist()
        if not some:
            return []
        sample = np.array(some, float)
        d = sample.shape[1]
        spread = data.select(F.posexplode("v").alias("j", "x")).groupBy("j").agg(F.var_pop("x").alias("var")).agg(F.avg("var")).first()[0] or 0.0
        fits = [Fit(k, s, plus_plus(sample, k, np.random.default_rng([seed, k, s]))) for k in ks for s in range(starts)]
        part = np.cumsum([f.k * d for f in fits]) // STACK  # as many fits at a time as the stack holds
        for p in np.unique(part):
            own = [f for f, q in zip(fits, part) if q == p]
            settle(own, lambda live: sums([sample], *stacked(live)), tol * spread, max_iter)
            for f in own:
                f.passes = 0
            passes = Passes(data)
            try:
                settle(own, passes, tol * spread, max_iter)
            finally:
                passes.drop()
            # distances to the centres of the last pass, computed in full
            _, cost, _ = _pass(data, [Fit(f.k, f.start, f.measured) for f in own])
            for f, c in zip(own, np.split(cost, np.cumsum([f.k for f in own])[:-1])):
                f.inertia = float(c.sum())
        return fits
    finally:
        data.unpersist()


def best_of(fits: list[Fit], k: int) -> Fit:
    return min((f for f in fits if f.k == k), key=lambda f: (f.inertia, f.start))


def elbow(df: DataFrame, ks, starts: int = 10, seed: int = 46, features: str = "features") -> DataFrame:
    """(k, inertia) of the best start of every k."""
    ks = list(ks)
    fits = fit_many(df, ks, starts, seed, features)
    return df.sparkSession.createDataFrame([(k, best_of(fits, k).inertia) for k in ks] if fits else [], "k int, inertia double")


class NearestCentre(_Stage, Transformer):
    """``prediction``: the number of the nearest centre (ties: the smallest)."""

    centres = _param("centres", "list of centres")
    features = _param("features", "vector or array column")

    @keyword_only
    def __init__(self, *, centres=None, features=None):
        super().__init__()
        self._setDefault(features="features")
        self._give(**self._input_kwargs)

    def clusterCenters(self) -> list[np.ndarray]:
        return [np.array(c) for c in self.given("centres")]

    def _transform(self, df: DataFrame) -> DataFrame:
        v = as_array(df, self.given("features"))
        gaps = F.array(*[F.aggregate(F.zip_with(v, F.array(*[F.lit(float(x)) for x in c]), lambda a, b: (a - b) * (a - b)),
                                     F.lit(0.0), lambda s, x: s + x) for c in self.given("centres")])
        return df.withColumn("prediction", (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int"))


def fit_best(df: DataFrame, k: int = 5, starts: int = 10, seed: int = 46, features: str = "features") -> tuple[NearestCentre, float]:
    """The best of several starts, as a transformer, and its inertia."""
    fit = best_of(fit_many(df, [k], starts, seed, features), k)
    return NearestCentre(centres=fit.centres.tolist(), features=features), fit.inertia
