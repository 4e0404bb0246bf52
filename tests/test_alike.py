"""Rows of equal features as one row and their number."""

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wellspark.operators import alike
from wellspark.operators import models as M


def _rows(spark, n=4000):
    x = [((i * 7) % 10, (i * 3) % 4) for i in range(n)]
    return spark.createDataFrame([([float(a), float(b)], float(a * a + 3 * b + (i % 5)), float((a + b + i % 2) % 3)) for i, (a, b) in enumerate(x)],
                                 "x array<double>, y double, c double").select(array_to_vector("x").alias("features"), "y", "c").persist()


def test_regressor_is_that_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(alike, "LEAST", 1)
    df = _rows(spark)
    few = alike.mean_of_alike(df, "features", "y", "w")
    assert few.count() == 20 and few.agg(F.sum("w")).first()[0] == 4000
    from pyspark.ml.regression import GBTRegressor
    whole = GBTRegressor(labelCol="y", maxIter=5, maxDepth=3, stepSize=0.1, seed=42).fit(df)
    own = M.fit_gbt_regressor(df, label="y", max_iter=5, depth=3)
    assert own.getWeightCol() == "_alike"
    a, b = (m.transform(df).agg(F.sum("prediction"), F.min("prediction"), F.max("prediction")).first() for m in (whole, own))
    assert all(abs(p - q) < 1e-6 * abs(p) for p, q in zip(a, b))


def test_classifier_is_that_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(alike, "LEAST", 1)
    df = _rows(spark)
    lr = LogisticRegression(labelCol="c", maxIter=200, family="multinomial", regParam=0.01)
    whole, own = lr.fit(df), alike.fit_classes(lr, df)
    assert own.getWeightCol() == "_alike"
    assert abs(whole.coefficientMatrix.toArray() - own.coefficientMatrix.toArray()).max() < 1e-2


def test_few_rows_stay(spark):
    assert alike.mean_of_alike(_rows(spark), "features", "y", "w") is None


def test_rows_that_differ_or_miss_a_label_stay(spark, monkeypatch):
    monkeypatch.setattr(alike, "LEAST", 1)
    df = spark.range(100).select(array_to_vector(F.array(F.col("id").cast("double"))).alias("features"), F.col("id").cast("double").alias("y"))
    assert alike.mean_of_alike(df, "features", "y", "w") is None
    same = df.select(array_to_vector(F.array(F.lit(1.0))).alias("features"), F.when(F.col("y") > 3, F.col("y")).alias("y"))
    assert alike.mean_of_alike(same, "features", "y", "w") is None
    assert alike.count_alike(same, "features", "y", "w") is None
