"""Many k-means fits at once against separate ones."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from wellspark.operators import manykmeans as MK
from wellspark.operators.models import total_sum_of_squares


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(7, 5))[rng.integers(0, 7, 900)] * 3 + 0.4 * rng.normal(size=(900, 5))
    x[:200] = x[0]  # a hot value
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(-1, None)], "id long, v array<double>").repartition(5)
    return df, x


def lloyd(x, centres, least_move, max_iter=300):
    for _ in range(max_iter):
        d = ((x[:, None] - centres) ** 2).sum(2)
        near = d.argmin(1)
        new = np.array([x[near == j].mean(0) if (near == j).any() else c for j, c in enumerate(centres)])
        if ((new - centres) ** 2).sum() <= least_move:
            break
        centres = new
    return d.min(1).sum()


def test_inertias_equal_separate_fits(spark, points, monkeypatch):
    df, x = points
    monkeypatch.setattr(MK, "SAMPLE", 120)  # most rows are only in the passes
    seen = []
    real = MK.settle
    monkeypatch.setattr(MK, "settle", lambda fits, *a: (seen.append([(f.k, f.start, f.centres.copy()) for f in fits]), real(fits, *a)))
    for stack in (1_000_000, 30):  # together, and a few at a time
        monkeypatch.setattr(MK, "STACK", stack)
        seen.clear()
        fits = MK.fit_many(df, [1, 2, 5, 7, 9], starts=3, features="v")
        least = 1e-4 * x.var(0).mean()
        begun = {(k, s): c for part in seen[1::2] for k, s, c in part}
        assert len(fits) == 15 and {(f.k, f.start) for f in fits} == set(begun)
        for f in fits:
            assert f.inertia == pytest.approx(lloyd(x, begun[f.k, f.start], least), rel=1e-9)


def test_as_good_as_the_library(spark, points):
    df, x = points
    model, inertia = MK.fit_best(df, 7, starts=10, features="v")
    other = KMeans(k=7, seed=1, featuresCol="f").fit(df.where("v IS NOT NULL").withColumn("f", array_to_vector("v"))).summary.trainingCost
    assert inertia <= other * 1.001
    got = model.transform(df.where("v IS NOT NULL")).collect()
    c = np.array(model.clusterCenters())
    assert all(r.prediction == ((np.array(r.v) - c) ** 2).sum(1).argmin() for r in got)
    table = {r.k: r.inertia for r in MK.elbow(df, range(1, 9), starts=4, features="v").collect()}
    assert table[1] == pytest.approx(total_sum_of_squares(df.where("v IS NOT NULL"), "v")) and table[7] < 0.2 * table[2]


def test_edges(spark, points, tmp_path):
    df, _ = points
    assert MK.elbow(df.limit(0), [1, 2], features="v").count() == 0
    same = spark.createDataFrame([([1.0, 2.0],)] * 6, "v array<double>")
    assert [f.inertia for f in MK.fit_many(same, [3], starts=2, features="v")] == [0.0, 0.0]  # more centres than values
    model, _ = MK.fit_best(df, 2, starts=1, features="v")
    PipelineModel([model]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    key = lambda m: sorted((r.id, r.prediction) for r in m.transform(df.where("v IS NOT NULL")).collect())
    assert key(again) == key(model)


def test_later_passes_try_few_rows_and_lose_none(spark, points):
    df, x = points
    data = df.select("v").where("v IS NOT NULL").persist()
    rng = np.random.default_rng(3)
    fits = [MK.Fit(k, s, MK.plus_plus(x, k, rng)) for k in (1, 4, 7) for s in range(2)]
    passes, tried = MK.Passes(data), []
    for _ in range(12):
        n, _cost, total = passes(fits)
        tried.append(passes.spent)
        want = MK.sums([x], *MK.stacked(fits))
        assert (n == want[0]).all() and np.allclose(total, want[2], rtol=1e-9, atol=1e-9)
        for f, m, t in zip(fits, np.split(n, MK.stacked(fits)[1][1:-1]), np.split(total, MK.stacked(fits)[1][1:-1])):
            f.centres = np.where(m[:, None] > 0, t / np.maximum(m, 1)[:, None], f.centres)
    passes.drop()
    data.unpersist()
    assert tried[-1] - tried[-2] < 0.2  # settled rows are not tried again
