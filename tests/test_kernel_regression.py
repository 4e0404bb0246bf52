"""Kernel regression without stored features, against MLlib on stored ones."""

import numpy as np
from wellspark.operators import models as M


def test_narrow_fit_equals_the_wide_one(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = np.c_[rng.integers(0, 9, 3000), rng.normal(size=3000)]
    y = 5 * np.sin(x[:, 0]) + x[:, 1] + rng.standard_t(2, 3000)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, label double").repartition(3)
    waves = {"n_features": 12, "gamma": 0.2}
    wide = M.rff_features(M.dealt_for_features(df), ["a", "b"], **waves)
    theirs = M.fit_kernel_regression(wide, inputs=["a", "b"], **waves)
    monkeypatch.setattr(M, "NARROW", 1000)
    assert M.dealt_for_features(df, rows=10).rdd.getNumPartitions() == 3  # no wide rows to deal
    monkeypatch.setattr(M, "LinearRegression", None)  # features would be stored
    mine = M.fit_kernel_regression(wide, inputs=["a", "b"], **waves)
    p, t = (np.array([r[0] for r in m.transform(f).orderBy("a", "b").select("prediction").collect()]) for m, f in ((mine, df), (theirs, wide)))
    y = np.array([r[0] for r in df.orderBy("a", "b").select("label").collect()])

    def loss(prediction, sigma):
        r = np.abs(y - prediction)
        return np.where(r <= 1.35 * sigma, sigma + r * r / sigma, sigma + 2.7 * r - 1.35 ** 2 * sigma).mean()

    assert loss(p, mine.given("sigma")) <= loss(t, theirs.scale) + 1e-9
    assert np.abs(p - t).max() < 0.1 and abs(mine.given("sigma") - theirs.scale) < 0.01 * theirs.scale
