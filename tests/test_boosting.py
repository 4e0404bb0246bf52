"""Softmax boosting against a plain numpy version, and its edge cases."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from wellspark.operators import boosting as B
from wellspark.operators import models as M


def _frame(spark, x, y, parts=4):
    rows = [(i, [float(v) for v in r], float(c)) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, features array<double>, label double").repartition(parts)


def _rings(n, seed):
    """Three classes: an inner disc, a ring and the corner beyond, one number missing."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, (n, 3))
    r = np.hypot(x[:, 0], x[:, 1])
    y = np.digitize(r, [0.45, 0.85])
    x[rng.random(n) < 0.05, 2] = np.nan
    return x, y


def _plain(x, y, classes, rounds, depth, step, edges):
    """Probabilities of a recursive version that tries every cut on its own."""
    b = B.to_bins(x, edges)
    n = np.bincount(y, minlength=classes)
    w = (len(y) / (classes * n))[y]
    margin = np.zeros((len(y), classes))

    def grow(rows, g, h, left):
        own = -g[rows].sum() / (h[rows].sum() + 1)
        best = (1e-6, None)
        for f in range(x.shape[1]) if left else ():
            for cut in range(1, B.BINS + 1):
                for missing in (True, False):
                    go = np.where(b[rows, f] == 0, missing, b[rows, f] <= cut)
                    a, z = rows[go], rows[~go]
                    if min(h[a].sum(), h[z].sum()) < 1:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (a, z)) - g[rows].sum() ** 2 / (h[rows].sum() + 1)
                    if gain > best[0] + 1e-12:
                        best = (gain, (a, z))
        if best[1] is None:
            return [(rows, own)]
        return [leaf for s in best[1] for leaf in grow(s, g, h, left - 1)]

    for _ in range(rounds):
        p = B.softmax(margin)
        for c in range(classes):
            g = np.rint(w * (p[:, c] - (y == c)) * B.WHOLE) / B.WHOLE
            h = np.rint(w * 2 * p[:, c] * (1 - p[:, c]) * B.WHOLE) / B.WHOLE
            for rows, value in grow(np.arange(len(y)), g, h, depth):
                margin[rows, c] += step * value
    return B.softmax(margin)


def _probabilities(model, df):
    got = model.transform(df).select("id", vector_to_array("probability").alias("p"), "prediction").orderBy("id").collect()
    return np.array([r.p for r in got]), np.array([r.prediction for r in got])


def test_equals_the_plain_version(spark):
    x, y = _rings(200, 1)
    model = B.fit_softmax(_frame(spark, x, y), 3, rounds=3, depth=2)
    p, _ = _probabilities(model, _frame(spark, x, y))
    assert np.allclose(p, _plain(x, y, 3, 3, 2, 0.3, model.given("edges")), atol=1e-9)
    assert np.allclose(p.sum(1), 1)


def test_trees_do_not_depend_on_tasks_parts_or_stored_margins(spark, monkeypatch):
    x, y = _rings(300, 2)
    want = B.fit_softmax(_frame(spark, x, y, 1), 3, rounds=4, depth=3).given("trees")
    monkeypatch.setattr(B, "CELLS", 2 * 3 * (B.BINS + 1))  # two nodes a pass
    monkeypatch.setattr(B, "KEPT", 2)
    assert B.fit_softmax(_frame(spark, x, y, 7), 3, rounds=4, depth=3).given("trees") == want


def test_learns_as_one_against_the_rest_does_and_is_saved(spark, tmp_path):
    x, y = _rings(1500, 3)
    x = np.nan_to_num(x)
    train, test = _frame(spark, x[:1000], y[:1000]), _frame(spark, x[1000:], y[1000:])
    model = M.fit_gbt_classifier(train, n_classes=3, max_iter=15, step=0.3, depth=3)
    p, mine = _probabilities(model, test)
    rest = M.fit_one_vs_rest(train.withColumn("features", M.array_to_vector("features")), max_iter=15, step=0.3, depth=3)
    theirs = np.array([r.prediction for r in rest.transform(test.withColumn("features", M.array_to_vector("features"))).orderBy("id").collect()])
    assert min((mine == y[1000:]).mean(), (theirs == y[1000:]).mean()) >= 0.9
    model.write().overwrite().save(f"{tmp_path}/model")
    again, _ = _probabilities(B.BoostedClasses.load(f"{tmp_path}/model"), test)
    assert (again == p).all()


def test_hot_rows_nulls_empty_tables_and_odd_labels(spark):
    rows = [([0.0, 1.0], 0.0)] * 40 + [([1.0, float("inf")], 1.0)] * 2 + [(None, 2.0), ([3.0, 3.0], None), ([2.0, -1.0], 4.0)] * 3
    df = spark.createDataFrame(rows, "features array<double>, label double")
    out = B.fit_softmax(df, 5, rounds=5, depth=2, least=0.1).transform(df)
    assert out.where("features IS NULL AND probability IS NULL AND prediction IS NULL").count() == 3
    assert out.where("label IS NOT NULL AND features IS NOT NULL AND prediction <> label").count() == 0
    none = B.fit_softmax(df.limit(0), 3).transform(df.where("features IS NOT NULL")).select(vector_to_array("probability")[0]).distinct().collect()
    assert [r[0] for r in none] == [pytest.approx(1 / 3)]
    with pytest.raises(ValueError):
        B.fit_softmax(df, 3)


def test_alike_rows_counted_together_give_the_same_trees(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 4, (600, 3)).astype(float)
    y = ((x[:, 0] + x[:, 1] + rng.integers(0, 2, 600)) % 3).astype(int)
    df = spark.createDataFrame([(v.tolist(), int(c)) for v, c in zip(x, y)], "features array<double>, label int").repartition(3)
    rows, real = [], B._sums
    monkeypatch.setattr(B, "_sums", lambda data, *a: (rows.append(data.count()), real(data, *a))[1])
    trees = []
    for share in (0.5, -1.0):
        monkeypatch.setattr(B, "ALIKE", share)
        trees.append(B.fit_softmax(df, 3, rounds=2, depth=2).given("trees"))
    assert trees[0] == trees[1] and min(rows) <= 3 * 64 and max(rows) == 600


def test_small_tables_take_no_job_a_level(spark, monkeypatch):
    x, y = _rings(300, 4)
    df = _frame(spark, x, y, 3)
    jobs, kind, real = [], type(df), type(df).mapInPandas
    monkeypatch.setattr(kind, "mapInPandas", lambda self, *a, **k: (jobs.append(a[1]), real(self, *a, **k))[1])
    held = B.fit_softmax(df, 3, rounds=12, depth=3).given("trees")
    assert len(jobs) == 1  # the bins
    monkeypatch.setattr(B, "HELD", 0)
    assert B.fit_softmax(df, 3, rounds=12, depth=3).given("trees") == held and len(jobs) > 30
