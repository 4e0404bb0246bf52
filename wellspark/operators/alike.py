"""Rows that a model cannot tell apart, as one row and their number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST = 0.5  # share of different rows up to which rows alike are put together
LEAST = 1_000_000  # rows from which on that is done; fewer are fitted as they are


def _few(df: DataFrame, keys: list[str], label: str) -> bool:
    """Whether there are ``LEAST`` rows, at most ``MOST`` of them differ in
    ``keys``, and none lacks features or label (these are left to the estimator)."""
    y = F.col(label)
    missing = F.col("features").isNull() | y.isNull()
    if dict(df.dtypes)[label] in ("float", "double"):
        missing = missing | F.isnan(y)
    got = df.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64(*keys)).alias("d"),
                 F.coalesce(F.bool_or(missing), F.lit(False)).alias("missing")).first()
    return got["n"] >= LEAST and not got["missing"] and got["d"] <= MOST * got["n"]


def mean_of_alike(df: DataFrame, features: str, label: str, weight: str) -> DataFrame | None:
    """One row for all of equal features: their mean label and their number.  A
    least-squares fit by these weights has the same optimum, and a tree the same
    gains, as rows of equal features never part; bin edges come from another
    sample.  None for few rows, or if too many differ."""
    rows = df.select(F.col(features).alias("features"), F.col(label).cast("double").alias(label))
    if not _few(rows, ["features"], label):
        return None
    return rows.groupBy("features").agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias(weight)) \
        .withColumnRenamed("features", features)


def count_alike(df: DataFrame, features: str, label: str, weight: str) -> DataFrame | None:
    """One row for all of equal features and label, and their number: any
    weighted loss is the same.  None for few rows, or if too many differ."""
    rows = df.select(F.col(features).alias("features"), label)
    if not _few(rows, ["features", label], label):
        return None
    return rows.groupBy("features", label).agg(F.count(F.lit(1)).cast("double").alias(weight)) \
        .withColumnRenamed("features", features)


def fit_least_squares(regressor, train: DataFrame):
    """Fits a boosted regressor of squared loss, on rows put together if many are alike."""
    few = mean_of_alike(train, regressor.getFeaturesCol(), regressor.getLabelCol(), "_alike")
    return _fit(regressor, train, few)


def fit_classes(classifier, train: DataFrame):
    """Fits a logistic regression, on rows put together if many are alike."""
    few = count_alike(train, classifier.getFeaturesCol(), classifier.getLabelCol(), "_alike")
    return _fit(classifier, train, few)


def _fit(estimator, train: DataFrame, few: DataFrame | None):
    if few is None:
        return estimator.fit(train)
    few = few.persist()
    try:
        return estimator.copy({estimator.weightCol: "_alike"}).fit(few)
    finally:
        few.unpersist()
