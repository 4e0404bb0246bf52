"""Model fitting on MLlib with the reference's settings.

Tree ensembles, boosted trees, linear models, k-means and perceptrons are
MLlib estimators (distributed fits).  Settings the reference takes from its
libraries are mapped explicitly: sklearn's ``C`` becomes ``regParam =
1 / (C * n)``, 'balanced' class weights become a weight column (k-means
with its starts is in ``manykmeans``), and an RBF kernel regression
becomes random Fourier features + a linear model.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier,
                                       LogisticRegression,
                                       MultilayerPerceptronClassifier,
                                       OneVsRest, RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Transformer

from wellspark.operators.alike import fit_least_squares
from wellspark.operators.boosting import fit_softmax
from wellspark.operators.profile import join_class_weight
from wellspark.operators.requests import _param, _Stage


def with_balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Adds ``weight`` = n / (classes * n_class) through a join with the
    per-class table (one row per class)."""
    return join_class_weight(df, label)


def fit_logreg(train: DataFrame, features: str = "features", label: str = "label", C: float = 1.0,
               max_iter: int = 5000, balanced: bool = False):
    n = train.count()
    lr = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                            regParam=1.0 / (C * n), elasticNetParam=0.0, maxIter=max_iter,
                            standardization=False)
    if balanced:
        train = with_balanced_weights(train, label)
        lr = lr.setWeightCol("weight")
    return lr.fit(train)


def fit_gbt_regressor(train: DataFrame, features="features", label="label", max_iter=20,
                      step=0.1, depth=5, seed=42):
    """Squared loss.  Where few rows differ in their features, those alike are
    one row of their mean label and their number (``alike``)."""
    gbt = GBTRegressor(featuresCol=features, labelCol=label, maxIter=max_iter, stepSize=step,
                       maxDepth=depth, seed=seed)
    return fit_least_squares(gbt, train)


def fit_gbt_classifier(train: DataFrame, n_classes: int, features="features", label="label",
                       max_iter=50, step=0.1, depth=5, balanced=True, seed=42):
    """Binary: GBTClassifier; more classes: boosting on the softmax loss, one
    tree a class and round (``boosting``)."""
    if n_classes > 2:
        return fit_softmax(train, n_classes, features, label, max_iter, step, depth, balanced)
    gbt = GBTClassifier(featuresCol=features, labelCol=label, maxIter=max_iter, stepSize=step,
                        maxDepth=depth, seed=seed)
    if balanced:
        train = with_balanced_weights(train, label)
        gbt = gbt.setWeightCol("weight")
    return gbt.fit(train)


def fit_one_vs_rest(train: DataFrame, features="features", label="label", max_iter=20, step=0.1, depth=5, seed=42):
    """One binary GBT a class, weighted to balance the classes."""
    gbt = GBTClassifier(featuresCol=features, labelCol=label, maxIter=max_iter, stepSize=step,
                        maxDepth=depth, seed=seed).setWeightCol("weight")
    return OneVsRest(classifier=gbt, featuresCol=features, labelCol=label, weightCol="weight").fit(
        with_balanced_weights(train, label))


def fit_gbt_imbalanced(train: DataFrame, features="features", label="label", pos_weight=100.0,
                       subsample=0.8, colsample="0.8", max_iter=20, depth=4, seed=42):
    t = train.withColumn("weight", F.when(F.col(label) == 1, F.lit(pos_weight)).otherwise(F.lit(1.0)))
    return GBTClassifier(featuresCol=features, labelCol=label, weightCol="weight", maxIter=max_iter,
                         maxDepth=depth, subsamplingRate=subsample, featureSubsetStrategy=colsample,
                         seed=seed).fit(t)


def fit_random_forest(train: DataFrame, features="features", label="label", trees=300, depth=12,
                      min_split=5, balanced=True, seed=46):
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, maxDepth=depth,
                                minInstancesPerNode=max(1, min_split // 2), seed=seed)
    if balanced:
        train = with_balanced_weights(train, label)
        rf = rf.setWeightCol("weight")
    return rf.fit(train)


def fit_decision_tree(train: DataFrame, depth: int, features="features", label="label",
                      balanced=True, seed=46):
    dt = DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=depth, seed=seed)
    if balanced:
        train = with_balanced_weights(train, label)
        dt = dt.setWeightCol("weight")
    return dt.fit(train)


def fit_mlp(train: DataFrame, layers: list[int], features="features", label="label", max_iter=200,
            seed=42):
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers,
                                          maxIter=max_iter, seed=seed).fit(train)


def total_sum_of_squares(df: DataFrame, features_array: str) -> float:
    """k = 1 inertia in closed form: sum of squared distances to the mean."""
    dim = len(df.select(features_array).first()[0])
    aggs = []
    for i in range(dim):
        x = F.col(features_array)[i]
        aggs += [F.sum(x * x).alias(f"q{i}"), F.sum(x).alias(f"s{i}")]
    row = df.agg(F.count(F.lit(1)).alias("n"), *aggs).first()
    n = row["n"]
    return float(sum(row[f"q{i}"] - row[f"s{i}"] ** 2 / n for i in range(dim)))


WIDE_ROWS = 250_000  # rows of features to a partition: 100 of them take 0.2 GB
NARROW = 1_000_000  # rows from which on a kernel regression never stores its features
BLOCK_ROWS = 1_000_000  # narrow rows in a block of such a fit


def dealt_for_features(df: DataFrame, rows: int = WIDE_ROWS) -> DataFrame:
    """Narrow rows dealt to so many partitions that each holds about ``rows``
    when it has got its features; as they are, if there are enough, or so many
    rows (``NARROW``) that no features are stored."""
    n_rows = df.count()
    if n_rows >= NARROW:
        return df
    n = -(-n_rows // rows)
    return df.repartition(n) if n > df.rdd.getNumPartitions() else df


def fourier(width: int, n_features: int = 100, gamma: float = 0.1, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_features, width))
    return W, rng.uniform(0.0, 2.0 * math.pi, size=n_features)


def waves(x: np.ndarray, W: np.ndarray, b: np.ndarray) -> np.ndarray:
    return math.sqrt(2.0 / len(b)) * np.cos(x @ W.T + b)


def rff_features(df: DataFrame, cols: list[str], n_features: int = 100, gamma: float = 0.1,
                 seed: int = 42, out: str = "features") -> DataFrame:
    """Random Fourier features z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma),
    computed per Arrow batch with numpy; W (D x d) is a seeded constant."""
    W, b = fourier(len(cols), n_features, gamma, seed)

    @F.pandas_udf("array<double>")
    def rff(*series: pd.Series) -> pd.Series:
        return pd.Series(list(waves(np.column_stack([s.to_numpy(dtype=np.float64) for s in series]), W, b)))

    return df.withColumn(out, array_to_vector(rff(*[F.col(c) for c in cols])))


class WaveRegression(_Stage, Transformer):
    """``prediction`` of a linear model of random Fourier features, from the
    columns that these are made of."""

    inputs = _param("inputs", "columns")
    waves = _param("waves", "frequencies of every feature")
    phases = _param("phases", "phase of every feature")
    coefficients = _param("coefficients", "coefficient of every feature")
    intercept = _param("intercept", "intercept")
    sigma = _param("sigma", "scale of the errors")

    @keyword_only
    def __init__(self, *, inputs=None, waves=None, phases=None, coefficients=None, intercept=None, sigma=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        W, b, beta, c = np.array(self.given("waves")), np.array(self.given("phases")), np.array(self.given("coefficients")), self.given("intercept")

        @F.pandas_udf("double")
        def predicted(*series: pd.Series) -> pd.Series:
            return pd.Series(waves(np.column_stack([s.to_numpy(dtype=np.float64) for s in series]), W, b) @ beta + c)

        return df.withColumn("prediction", predicted(*[F.col(x).cast("double") for x in self.given("inputs")]))


def _blocks(width: int):
    """Rows in blocks: the different inputs, each row's number among them, labels."""
    def run(batches):
        def block():
            rows = pd.concat(held, ignore_index=True)
            held.clear()
            code = np.zeros(len(rows), np.int64)
            for j in range(width):
                c, seen = pd.factorize(rows[f"x{j}"])
                code, _ = pd.factorize(code * len(seen) + c)
            first = np.zeros(code.max() + 1, np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            x = rows[[f"x{j}" for j in range(width)]].to_numpy(np.float64)[first]
            return pd.DataFrame({"x": [x.tobytes()], "code": [code.astype(np.int32).tobytes()], "y": [rows["y"].to_numpy(np.float64).tobytes()]})

        held, n = [], 0
        for b in batches:
            if len(b):
                held.append(b)
                n += len(b)
            if n >= BLOCK_ROWS:
                yield block()
                n = 0
        if held:
            yield block()
    return run


def _huber_sums(x: np.ndarray, code: np.ndarray, y: np.ndarray, W, b, beta: np.ndarray, sigma: float, eps: float) -> np.ndarray:
    """Loss, gradient and second derivatives, in one flat array, of the Huber
    loss with scale in (coefficients, intercept, sigma)."""
    z = np.column_stack([waves(x, W, b), np.ones(len(x))])
    r = y - (z @ beta)[code]
    inner = np.abs(r) <= eps * sigma
    q = r / sigma
    loss = np.where(inner, sigma + q * r, sigma + 2 * eps * np.abs(r) - eps * eps * sigma).sum()
    slope = np.bincount(code, np.where(inner, 2 * q, 2 * eps * np.sign(r)), len(x))
    n_in, r_in = np.bincount(code, inner, len(x)), np.bincount(code, np.where(inner, r, 0.0), len(x))
    q2 = float((q[inner] ** 2).sum())
    d = z.shape[1]
    hess = np.zeros((d + 1, d + 1))
    hess[:d, :d] = (z * (2 / sigma * n_in)[:, None]).T @ z
    hess[:d, d] = hess[d, :d] = 2 / sigma ** 2 * (z.T @ r_in)
    hess[d, d] = 2 / sigma * q2
    grad = np.r_[-(z.T @ slope), inner.sum() - q2 + (~inner).sum() * (1 - eps * eps)]
    return np.concatenate([[loss], grad, hess.ravel()])


def _fit_waves(rows: DataFrame, cols: list[str], label: str, W: np.ndarray, b: np.ndarray, eps: float = 1.35,
               max_iter: int = 200, tol: float = 1e-9) -> WaveRegression:
    """Huber's loss with its scale by Newton steps: a pass adds up loss, gradient
    and second derivatives of blocks, whose features are made anew for the
    different inputs of a block, so no wide row is ever stored."""
    x = rows.select(*[F.col(c).cast("double").alias(f"x{j}") for j, c in enumerate(cols)], F.col(label).cast("double").alias("y"))
    start = x.agg(F.avg("y").alias("m"), F.stddev_pop("y").alias("s")).first()
    data = x.mapInPandas(_blocks(len(cols)), "x binary, code binary, y binary").persist(StorageLevel.MEMORY_AND_DISK)
    d, tasks = len(b) + 2, 2 * rows.sparkSession.sparkContext.defaultParallelism

    def sums(at):
        def run(batches):
            total = 0.0
            for batch in batches:
                for u, code, y in zip(batch["x"], batch["code"], batch["y"]):
                    total = total + _huber_sums(np.frombuffer(u).reshape(-1, len(cols)), np.frombuffer(code, np.int32), np.frombuffer(y), W, b, at[:-1], at[-1], eps)
            if not np.isscalar(total):
                yield pd.DataFrame({"s": [total.tobytes()]})

        # a row a task, and few tasks: what the driver reads depends on the features, never on the rows
        total = sum(np.frombuffer(bytes(r["s"])) for r in data.coalesce(tasks).mapInPandas(run, "s binary").collect())
        return total[0], total[1:d + 1], total[d + 1:].reshape(d, d)

    try:
        least = 1e-9 * max(start["s"], np.finfo(float).tiny)
        at = np.r_[np.zeros(len(b)), start["m"], max(start["s"], least)]
        f, grad, hess = sums(at)
        for _ in range(max_iter):
            # by main directions of equal scale: those without curvature are left as they are
            scale = 1 / np.sqrt(np.maximum(np.diag(hess), np.finfo(float).tiny))
            bend, main = np.linalg.eigh(hess * scale[:, None] * scale)
            some = bend > 1e-12 * bend[-1]
            step = -scale * (main[:, some] @ ((main[:, some].T @ (scale * grad)) / bend[some]))
            if -grad @ step <= tol * abs(f):
                break
            size = 1.0
            if at[-1] + step[-1] < 0.1 * at[-1]:
                size = 0.9 * at[-1] / -step[-1]
            while size > 1e-6:
                new = sums(at + size * step)
                if new[0] <= f + 1e-4 * size * (grad @ step):
                    break
                size /= 2
            else:
                break
            at, (f, grad, hess) = at + size * step, new
            if at[-1] <= least:
                break
    finally:
        data.unpersist()
    return WaveRegression(inputs=cols, waves=W.tolist(), phases=b.tolist(), coefficients=at[:len(b)].tolist(), intercept=float(at[-2]), sigma=float(at[-1]))


def fit_kernel_regression(train: DataFrame, label="label", features="features", reg=0.0, inputs: list[str] | None = None, **waves_of):
    """Huber regression on ``features``.  With ``inputs``, the columns that
    ``rff_features`` made them of (and its settings), many rows (``NARROW``)
    are fitted without storing their features."""
    if inputs and not reg:
        known = [F.col(c).cast("double") for c in [*inputs, label]]
        whole = F.coalesce(F.bool_and(reduce(lambda a, c: a & c.isNotNull() & (F.abs(c) < float("inf")), known, F.lit(True))), F.lit(False))
        got = train.agg(F.count(F.lit(1)).alias("n"), whole.alias("whole")).first()
        if got["n"] >= NARROW and got["whole"]:
            return _fit_waves(train, inputs, label, *fourier(len(inputs), **waves_of))
        if got["n"] >= NARROW:
            train = train.repartition(-(-got["n"] // WIDE_ROWS))
    return LinearRegression(featuresCol=features, labelCol=label, loss="huber", regParam=reg,
                            maxIter=200).fit(train)


def importances(model, names: list[str]) -> list[tuple[str, float]]:
    imp = model.featureImportances.toArray()
    return [(n, float(v)) for n, v in zip(names, imp)]


def probabilities_map(df: DataFrame, labels: list[str], prob_col="probability", out="probs"):
    """Class name -> probability as a MAP column (labels from the fitted indexer)."""
    arr = vector_to_array(prob_col)
    return df.withColumn(out, F.map_from_arrays(F.array(*[F.lit(x) for x in labels]),
                                                F.transform(arr, lambda p: F.round(p, 4))))
