"""Feature encoders fitted on train and applied as expressions.

Fitted state is tiny (means, stds, category lists, label codes) and is
carried as literals in one Project -- never a per-row Python call.  Category
lists are bounded: fitting refuses more than ``MAX_CATEGORIES`` values, since
an unbounded one-hot is not a categorical feature.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.functions.columns import FALLBACK_LABEL

MAX_CATEGORIES = 10_000


def drop_leakage(df: DataFrame, target: str, drop=(), strict: bool = False):
    """(features, target) frames; unknown names are skipped unless ``strict``."""
    if strict:
        missing = [c for c in [target, *drop] if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(target, *drop), df.select(target)


def align_columns(df: DataFrame, expected: list[str], fill=0) -> DataFrame:
    """Exactly the training columns, in order; absent ones are ``fill``."""
    have = set(df.columns)
    return df.select([F.col(c) if c in have else F.lit(fill).alias(c) for c in expected])


def decode_label(df: DataFrame, code_col: str, names: dict, out: str = "label_name",
                 fallback: str = FALLBACK_LABEL) -> DataFrame:
    """Code -> name from a fixed, bounded mapping; unknown codes get ``fallback``."""
    pairs = []
    for k, v in names.items():
        pairs += [F.lit(k), F.lit(v)]
    lookup = F.create_map(*pairs)
    return df.withColumn(out, F.coalesce(lookup[F.col(code_col)], F.lit(fallback)))


# ------------------------------------------------------------------- scaling

class ZScore:
    """(x - mean) / population std, fitted in one aggregate on train."""

    def __init__(self, cols: list[str]):
        self.cols = list(cols)
        self.mean: dict = {}
        self.std: dict = {}

    def fit(self, train: DataFrame) -> "ZScore":
        aggs = []
        for c in self.cols:
            aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
        row = train.agg(*aggs).first()
        self.mean = {c: row[f"m_{c}"] for c in self.cols}
        self.std = {c: row[f"s_{c}"] for c in self.cols}
        return self

    def expr(self, c: str) -> Column:
        s = self.std[c] or 1.0
        return (F.col(c) - F.lit(float(self.mean[c]))) / F.lit(float(s))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.expr(c) for c in self.cols})

    def params(self, spark: SparkSession) -> DataFrame:
        from wellspark.operators.clean import params_frame
        rows = [("mean", c, v, None) for c, v in self.mean.items()]
        rows += [("std", c, v, None) for c, v in self.std.items()]
        return params_frame(spark, rows)


# ------------------------------------------------------------------ one-hot

def fit_categories(train: DataFrame, cols: list[str]) -> dict:
    """Sorted distinct non-null values per column.  The distinct values meet in
    a shuffle; at most one more than ``MAX_CATEGORIES`` of them is read back, so
    a column with too many is refused before it can fill a task or the driver."""
    out = {}
    for c in cols:
        found = train.select(F.col(c).alias("v")).where("v IS NOT NULL").distinct().limit(MAX_CATEGORIES + 1).collect()
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"{c}: more than {MAX_CATEGORIES} categories")
        out[c] = sorted(r.v for r in found)
    return out


def indicator_name(col: str, value) -> str:
    return f"{col}_{value}"


def one_hot(df: DataFrame, categories: dict, drop_first: bool = True,
            keep_source: bool = False) -> DataFrame:
    """0/1 columns ``col_VALUE`` per fitted category.  ``drop_first`` drops
    the alphabetically first category (pandas ``get_dummies(drop_first=True)``);
    null or unseen values give all zeros."""
    exprs = {}
    for c, vals in categories.items():
        use = vals[1:] if drop_first else vals
        for v in use:
            exprs[indicator_name(c, v)] = F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0))
    out = df.withColumns(exprs)
    return out if keep_source else out.drop(*categories.keys())


# ------------------------------------------------------------- label codes

class LabelEncoder:
    """Class name -> 0-based code in alphabetical order; unseen names raise."""

    def __init__(self, col: str, out: str | None = None):
        self.col = col
        self.out = out or f"{col}_code"
        self.labels: list = []

    def fit(self, train: DataFrame) -> "LabelEncoder":
        self.labels = fit_categories(train, [self.col])[self.col]
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        pairs = []
        for i, v in enumerate(self.labels):
            pairs += [F.lit(v), F.lit(i)]
        code = F.create_map(*pairs)[F.col(self.col)]
        checked = F.when(code.isNull() & F.col(self.col).isNotNull(),
                         F.raise_error(F.concat(F.lit("unseen label: "), F.col(self.col).cast("string"))))
        return df.withColumn(self.out, F.coalesce(code, checked.cast("int")))


def assemble_vector(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


# ---------------------------------------------------------------- ANOVA F

def anova_f(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """One-way ANOVA F per feature (``f_classif``), as grouped sums.

    The rows are melted to (feature, class, x) and reduced to
    classes x features partial sums with map-side combine; the F statistics
    come from that small table."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"))
                                for c in features]))
    long = df.select(F.col(label).alias("cls"), pairs.alias("p")).select("cls", "p.*") \
        .where(F.col("x").isNotNull())
    g = long.groupBy("feature", "cls").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"),
                                           F.sum(F.col("x") * F.col("x")).alias("ss"))
    t = g.groupBy("feature").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("s").alias("s"),
        F.sum("ss").alias("ss"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("between_raw"))
    ssb = F.col("between_raw") - F.col("s") * F.col("s") / F.col("n")
    ssw = F.col("ss") - F.col("between_raw")
    f = (ssb / (F.col("k") - 1)) / (ssw / (F.col("n") - F.col("k")))
    return t.select("feature", f.alias("f_score"))


def select_k_best(df: DataFrame, label: str, features: list[str], k: int) -> list[str]:
    """Names of the k features with the highest F (ties: name order)."""
    scores = anova_f(df, label, features).orderBy(F.desc("f_score"), "feature").limit(k)
    return [r.feature for r in scores.collect()]
