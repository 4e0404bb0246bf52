"""Resampling and selection inside each fold."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wellspark.operators import tune as TU
from wellspark.operators.evaluate import fbeta
from wellspark.operators.split import stratified_folds


def _rare(spark, n=240):
    """A rare class apart in the second of three numbers."""
    rng = np.random.default_rng(5)
    y = (np.arange(n) % 8 == 0).astype(int)
    x = rng.normal(0, 1, (n, 3))
    x[:, 1] += 2.5 * y
    return spark.createDataFrame([(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))], "id long, vec array<double>, label int")


def test_validation_rows_are_never_resampled(spark, monkeypatch):
    df, seen, judged = _rare(spark), [], []

    def watched(rows, *args, real=TU.smote_tomek, **kw):
        out = real(rows, *args, **kw)
        seen.append(({r.id for r in rows.collect()}, out.collect()))
        return out

    def scored(rows, *args, real=TU.fbeta):
        judged.append(sorted(r.id for r in rows.collect()))
        return real(rows, *args)

    monkeypatch.setattr(TU, "smote_tomek", watched)
    monkeypatch.setattr(TU, "fbeta", scored)
    tree = DecisionTreeClassifier(seed=1)
    model, table = TU.balanced_grid(df, TU.BalancedFit(base=tree, seed=46), {tree.maxDepth: [2]}, ratios=[1.0], k_bests=[1], folds=3)
    folds = stratified_folds(df, "id", "label", 3, 46).collect()
    for f in range(3):
        held = {r.id for r in folds if r.fold == f}
        given, made = seen[f]
        assert given == {r.id for r in folds} - held and judged[f] == sorted(held)
        assert any(r.synthetic for r in made) and not {r.id for r in made} & held
        minority = np.array([r.vec for r in folds if r.fold != f and r.label == 1])
        low, high = minority.min(0) - 1e-9, minority.max(0) + 1e-9
        assert all((low <= r.vec).all() and (r.vec <= high).all() for r in made if r.synthetic)
    assert TU.selected(model) == [1] and table.count() == 1
    out = model.transform(df)
    assert out.count() == 240 and fbeta(out, 2.0).first()[0] > 0.6


def test_scores_equal_fits_made_apart(spark):
    df = _rare(spark)
    tree = DecisionTreeClassifier(seed=1)
    fit = TU.BalancedFit(base=tree)
    got = TU.balanced_grid(df, fit, {tree.maxDepth: [1, 3]}, k_bests=[1, None], folds=2)[1].orderBy("candidate").collect()
    assert [(r.ratio, r.k_best, r.params) for r in got] == [(None, 1, "maxDepth=1"), (None, 1, "maxDepth=3"), (None, None, "maxDepth=1"), (None, None, "maxDepth=3")]
    folds = stratified_folds(df, "id", "label", 2, 46).withColumn("features", array_to_vector("vec")).withColumn("label", F.col("label").cast("double"))
    apart = [fbeta(tree.copy({tree.maxDepth: 3}).fit(folds.where(F.col("fold") != f)).transform(folds.where(F.col("fold") == f)), 2.0).first()[0] for f in (0, 1)]
    assert got[3].mean_metric == pytest.approx(np.mean(apart)) and got[3].std_metric == pytest.approx(np.std(apart))


def test_rows_without_id_vector_or_label_are_left_out(spark):
    df = _rare(spark)
    odd = df.unionByName(spark.createDataFrame([(None, [0.0] * 3, 1), (900, None, 0), (901, [1.0] * 3, None)], df.schema))
    tree = DecisionTreeClassifier(seed=1)
    one, two = (TU.balanced_grid(d, TU.BalancedFit(base=tree), {tree.maxDepth: [2]}, ratios=[0.6], folds=2)[1].first().mean_metric for d in (df, odd))
    assert one == two
