"""Cleaning with constants learned on the training split only.

Every fitted constant (median, mode, IQR limits, mean/std, categories) ends
up in one small parameter table ``(param, column, value, text)`` that can be
written next to the data and read back at scoring time.  Applying the
constants is a single Project/Filter: no per-column jobs, no repeated
actions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspark.functions.columns import (UNKNOWN, all_of, columns_of_type,
                                         yes_no_bool)
from wellspark.operators.quantiles import quantiles

PARAM_SCHEMA = T.StructType([
    T.StructField("param", T.StringType(), False),
    T.StructField("column", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("text", T.StringType(), True),
])


def params_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Fitted constants as a DataFrame (size = columns x params, never rows)."""
    return spark.createDataFrame(
        [(p, c, None if v is None else float(v), t) for p, c, v, t in rows], PARAM_SCHEMA)


# --------------------------------------------------------------------- audits

def null_audit(df: DataFrame) -> DataFrame:
    """One row, one column per input column, holding its null count."""
    return df.select([F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in df.columns])


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def filter_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull())


# ----------------------------------------------------------------- IQR limits

def iqr_limits(df: DataFrame, factor: float, cols: list[str] | None = None,
               exclude: tuple[str, ...] = (), rel_err: float | None = None) -> dict:
    """``{column: (lower, upper)}`` = q1 - f*iqr, q3 + f*iqr for every numeric
    column in ONE pass family (not one job per column).  Exact discrete
    quantiles by default; ``rel_err`` > 0 uses one-pass Greenwald-Khanna.
    A column with no non-null value is skipped (reported by ``limits_frame``)."""
    cols = cols or [c for c in columns_of_type(df, "numeric") if c not in exclude]
    qs = quantiles(df, cols, [0.25, 0.75], kind="disc", rel_err=rel_err)
    out = {}
    for c in cols:
        q1, q3 = qs.get(("", c, 0.25)), qs.get(("", c, 0.75))
        if q1 is None or q3 is None:
            continue
        iqr = q3 - q1
        out[c] = (q1 - factor * iqr, q3 + factor * iqr)
    return out


def limits_frame(spark: SparkSession, limits: dict) -> DataFrame:
    rows = []
    for c, (lo, hi) in limits.items():
        rows += [("iqr_lower", c, lo, None), ("iqr_upper", c, hi, None)]
    return params_frame(spark, rows)


def iqr_predicate(limits: dict):
    """Inclusive limits on every listed column in one predicate; a null fails."""
    return all_of([F.coalesce(F.col(c).between(F.lit(lo), F.lit(hi)), F.lit(False))
                   for c, (lo, hi) in limits.items()])


def iqr_filter(df: DataFrame, limits: dict) -> DataFrame:
    return df.where(iqr_predicate(limits))


def retention_report(splits: dict[str, DataFrame], keep_pred, step: str = "iqr") -> DataFrame:
    """Rows before, kept, removed and percent removed per split, in one job:
    the splits are tagged and unioned, and the kept count is a conditional
    count, so there is no second ``count()`` action."""
    tagged = None
    for name, d in splits.items():
        part = d.select(F.lit(name).alias("split"), keep_pred.alias("_keep"))
        tagged = part if tagged is None else tagged.unionByName(part)
    agg = tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col("_keep")).alias("rows_kept"))
    return (agg.withColumn("rows_removed", F.col("rows_before") - F.col("rows_kept"))
            .withColumn("pct_removed",
                        F.round(F.col("rows_removed") * 100.0 / F.col("rows_before"), 4))
            .withColumn("step", F.lit(step)))


# ---------------------------------------------------------------------- modes

def binary_mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent trimmed lower-case value of a yes/no column (ties: the
    smaller value), and whether it is 'yes'.  A partial+final aggregate on
    the distinct values, then a top-1: no row is pulled to the driver."""
    v = F.trim(F.lower(F.col(col)))
    counts = df.where(F.col(col).isNotNull()).groupBy(v.alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    return (counts.orderBy(F.desc("n"), F.asc("value")).limit(1)
            .select(F.lit(col).alias("column"), "value", "n",
                    (F.col("value") == "yes").alias("is_yes")))


def fit_binary_modes(df: DataFrame, cols: list[str]) -> dict:
    """All yes/no modes in ONE aggregate (max_by over value counts per column)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                         F.trim(F.lower(F.col(c))).alias("value")) for c in cols]))
    counts = (df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))
    return {r.column: (r.mode == "yes") for r in best.collect()}


# ----------------------------------------------------------------- imputation

def median_fit(df: DataFrame, cols: list[str], rel_err: float | None = None) -> dict:
    """Exact medians (linear interpolation, as ``percentile``/``quantile_cont``)."""
    qs = quantiles(df, cols, [0.5], kind="cont", rel_err=rel_err)
    return {c: qs.get(("", c, 0.5)) for c in cols}


def fill_constant(df: DataFrame, cols: list[str], value: str = UNKNOWN) -> DataFrame:
    return df.na.fill(value, subset=cols)


def fill_empty(col) -> "F.Column":
    return F.coalesce(col, F.lit(""))


class Imputation:
    """Constant / median / mode imputation fitted on train, applied to any
    split as one Project.  ``bool_cols`` are yes/no texts turned boolean with
    the train mode as the fallback; ``median_cols`` get the train median;
    ``category_cols`` get ``unknown``."""

    def __init__(self, category_cols, median_cols, bool_cols, rel_err=None):
        self.category_cols = list(category_cols)
        self.median_cols = list(median_cols)
        self.bool_cols = list(bool_cols)
        self.rel_err = rel_err
        self.medians: dict = {}
        self.modes: dict = {}

    def fit(self, train: DataFrame) -> "Imputation":
        self.medians = median_fit(train, self.median_cols, self.rel_err) if self.median_cols else {}
        self.modes = fit_binary_modes(train, self.bool_cols) if self.bool_cols else {}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c in self.category_cols:
            exprs[c] = F.coalesce(F.col(c), F.lit(UNKNOWN))
        for c in self.median_cols:
            m = self.medians.get(c)
            exprs[c] = F.col(c) if m is None else F.coalesce(
                F.col(c).cast("double"), F.lit(float(m)))
        for c in self.bool_cols:
            exprs[c] = yes_no_bool(F.col(c), self.modes.get(c, False))
        return df.withColumns(exprs)

    def params(self, spark: SparkSession) -> DataFrame:
        rows = [("median", c, v, None) for c, v in self.medians.items()]
        rows += [("mode", c, 1.0 if v else 0.0, "yes" if v else "no") for c, v in self.modes.items()]
        rows += [("fill", c, None, UNKNOWN) for c in self.category_cols]
        return params_frame(spark, rows)
