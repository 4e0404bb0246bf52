"""Model search: cross-validated grids, depth scans, seeded random search,
experiment comparison.  Each candidate fit is a distributed MLlib job; the
search loop runs in driver threads (``parallelism``)."""

from __future__ import annotations

import random
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.feature import UnivariateFeatureSelector
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import (CrossValidator, ParamGridBuilder,
                               TrainValidationSplit)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.operators.evaluate import fbeta, macro_f1
from wellspark.operators.neighbors import smote_tomek
from wellspark.operators.requests import _param, _Stage
from wellspark.operators.split import stratified_folds


def grid_search(estimator, grid: dict, evaluator, train: DataFrame, folds: int = 5,
                fold_col: str | None = None, parallelism: int = 4, seed: int = 42):
    """Cross-validated grid; returns (best model refitted on all train,
    results table with one row per parameter map: params, mean, std)."""
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, values)
    maps = builder.build()
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                        numFolds=folds, parallelism=parallelism, seed=seed, collectSubModels=False)
    if fold_col:
        cv = cv.setFoldCol(fold_col)
    model = cv.fit(train)
    return model, results_table(train.sparkSession, maps, model.avgMetrics, model.stdMetrics)


def results_table(spark: SparkSession, maps, means, stds=None) -> DataFrame:
    rows = []
    for i, pm in enumerate(maps):
        params = ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))
        rows.append((i, params, float(means[i]), float(stds[i]) if stds is not None else None))
    return spark.createDataFrame(rows, "candidate int, params string, mean_metric double, std_metric double")


def random_search(estimator, space: dict, evaluator, train: DataFrame, trials: int = 10,
                  train_ratio: float = 0.8, seed: int = 42, parallelism: int = 4):
    """Seeded random parameter maps evaluated by one train/validation split."""
    rng = random.Random(seed)
    maps = []
    for _ in range(trials):
        maps.append({p: (rng.choice(v) if isinstance(v, list) else v(rng)) for p, v in space.items()})
    tvs = TrainValidationSplit(estimator=estimator, estimatorParamMaps=maps, evaluator=evaluator,
                               trainRatio=train_ratio, seed=seed, parallelism=parallelism)
    model = tvs.fit(train)
    return model, results_table(train.sparkSession, maps, model.validationMetrics)


def compare_models(predictions: dict[str, DataFrame], base: str, label: str = "label",
                   prediction: str = "prediction") -> DataFrame:
    """One row per experiment with its macro F1 and the gain over the base
    experiment in percent (a join with the base row, no driver loop)."""
    parts = [macro_f1(df, label, prediction).select(F.lit(name).alias("experiment"), "macro_f1")
             for name, df in predictions.items()]
    allm = reduce(lambda a, b: a.unionByName(b), parts)
    base_f1 = allm.where(F.col("experiment") == base).select("macro_f1").scalar()  # scalar subquery
    return allm.select(
        "experiment", F.round("macro_f1", 6).alias("macro_f1"),
        F.round((F.col("macro_f1") - base_f1) / base_f1 * 100, 4).alias("gain_pct"))


class BalancedFit(_Stage, Estimator):
    """Resamples, selects features and fits, in this order and on the rows given
    to ``fit`` alone; the fitted model only selects and predicts, so rows to be
    predicted are never resampled.

    ``ratio``: minority rows to reach, as a share of the majority (SMOTE, then
    Tomek links removed; null: as they are); ``k_best``: features kept by
    their F test against the label (null: all).  Ids must be unique; rows
    without an id, vector or label are left out."""

    ratio = _param("ratio", "minority share to reach")
    k_best = _param("k_best", "features to keep")
    id_col = _param("id_col", "unique id")
    vec = _param("vec", "array column")
    label = _param("label", "0 or 1")
    minority = _param("minority", "label of the rarer class")
    seed = _param("seed", "seed")

    @keyword_only
    def __init__(self, *, base=None, ratio=None, k_best=None, id_col=None, vec=None, label=None, minority=None, seed=None):
        super().__init__()
        given = dict(self._input_kwargs)
        self.base = given.pop("base", None)
        self._setDefault(ratio=None, k_best=None, id_col="id", vec="vec", label="label", minority=1, seed=46)
        self._give(**given)

    def balanced(self, df: DataFrame) -> DataFrame:
        """(id, vec, label) of the rows to fit on; synthetic rows have no id."""
        i, v, y = self.given("id_col"), self.given("vec"), self.given("label")
        rows = df.select(i, F.col(v).cast("array<double>").alias("vec"), F.col(y).cast("int").alias(y)) \
            .where(F.col(i).isNotNull() & F.col("vec").isNotNull() & F.col(y).isNotNull())
        if self.given("ratio") is None:
            return rows
        return smote_tomek(rows, i, "vec", y, self.given("minority"), self.given("ratio"), seed=self.given("seed")).select(i, "vec", y)

    def fit_balanced(self, table: DataFrame) -> PipelineModel:
        """The model of an already resampled table."""
        y = self.given("label")
        table = table.select(array_to_vector("vec").alias("_all"), F.col(y).cast("double").alias(y))
        stages = [_Vector(vec=self.given("vec"))]
        features = "_all"
        if self.given("k_best") is not None:
            pick = UnivariateFeatureSelector(featuresCol="_all", labelCol=y, outputCol="_best").setFeatureType("continuous") \
                .setLabelType("categorical").setSelectionThreshold(self.given("k_best"))
            stages.append(pick.fit(table))
            table, features = stages[-1].transform(table), "_best"
        base = self.base.copy({self.base.featuresCol: features, self.base.labelCol: y})
        return PipelineModel([*stages, base.fit(table)])

    def _fit(self, df: DataFrame) -> PipelineModel:
        return self.fit_balanced(self.balanced(df))


class _Vector(_Stage, Transformer):
    """``_all``: the array column as a vector."""

    vec = _param("vec", "array column")

    @keyword_only
    def __init__(self, *, vec=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_all", array_to_vector(F.col(self.given("vec")).cast("array<double>")))


def selected(model: PipelineModel) -> list[int] | None:
    """Numbers of the features that a ``BalancedFit`` model kept (null: all)."""
    picks = [s for s in model.stages if hasattr(s, "selectedFeatures")]
    return sorted(picks[0].selectedFeatures) if picks else None


def balanced_grid(train: DataFrame, estimator: BalancedFit, grid: dict, ratios=(None,), k_bests=(None,), folds: int = 5,
                  beta: float = 2.0, parallelism: int = 4):
    """Cross-validated grid over resampling ratio, number of features and the
    parameters of the base model, by F-beta of the minority class on untouched
    validation rows.

    The folds are dealt once into one cached table; a fold's training rows are
    resampled once a ratio, and all candidates of that ratio fit on the result.
    Returns (best model refitted on all rows, one row a candidate); ties go to
    the first candidate.  Each fold counts alike; a fold without a minority row
    and without a prediction of it counts 0."""
    i, v, y, positive = (estimator.given(n) for n in ("id_col", "vec", "label", "minority"))
    base_maps = [dict(zip(grid, values)) for values in product(*grid.values())]
    candidates = [(r, k, m) for r in ratios for k in k_bests for m in range(len(base_maps))]
    scores: dict[tuple, list[float]] = {c: [] for c in candidates}

    def candidate(c):
        own = estimator.copy({estimator.ratio: c[0], estimator.k_best: c[1]})
        own.base = estimator.base.copy(base_maps[c[2]])
        return own

    rows = train.where(F.col(i).isNotNull() & F.col(v).isNotNull() & F.col(y).isNotNull()).select(i, v, y)
    dealt = stratified_folds(rows, i, y, folds, estimator.given("seed")).persist(StorageLevel.MEMORY_AND_DISK)
    pool = ThreadPool(parallelism)
    try:
        for fold in range(folds):
            held = dealt.where(F.col("fold") == fold)
            for r in ratios:
                own = [c for c in candidates if c[0] == r]
                table = candidate(own[0]).balanced(dealt.where(F.col("fold") != fold)).persist(StorageLevel.MEMORY_AND_DISK)
                try:
                    table.count()
                    got = pool.map(lambda c, t=table, h=held: fbeta(candidate(c).fit_balanced(t).transform(h), beta, y, "prediction", positive).first()[0], own)
                finally:
                    table.unpersist()
                for c, x in zip(own, got):
                    scores[c].append(float(x))
    finally:
        pool.close()
        dealt.unpersist()
    best = max(candidates, key=lambda c: fmean(scores[c]))
    out = [(n, c[0], c[1], ", ".join(f"{p.name}={x}" for p, x in sorted(base_maps[c[2]].items(), key=lambda kv: kv[0].name)),
            fmean(scores[c]), pstdev(scores[c])) for n, c in enumerate(candidates)]
    table = train.sparkSession.createDataFrame(out, "candidate int, ratio double, k_best int, params string, mean_metric double, std_metric double")
    return candidate(best).fit(train), table
