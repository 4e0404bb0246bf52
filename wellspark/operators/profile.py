"""Profiling aggregates: audits, summaries, frequency tables, histograms,
box statistics, class weights.  Each is one aggregate (partial + final, so
map-side combine happens before the shuffle) plus, where needed, a join with
a small per-group table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.operators.quantiles import quantiles

BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after checking the row count of a small
    (aggregated) frame; otherwise leave the strategy to the planner."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def profile_audit(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: type, nulls, percent null, distinct count -- one pass.
    ``approx`` uses HyperLogLog++ instead of exact distinct counts."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs.append(F.sum(F.col(c).isNull().cast("bigint")).alias(f"_z{i}"))
        aggs.append((F.approx_count_distinct(c) if approx else F.count_distinct(c)).alias(f"_d{i}"))
    one = df.agg(*aggs)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"),
                 F.col(f"_z{i}").alias("n_null"), F.col(f"_d{i}").cast("bigint").alias("n_distinct"))
        for i, c in enumerate(cols)]))
    return (one.select("_n", entries.alias("e")).select("_n", "e.*")
            .withColumn("pct_null", F.round(F.col("n_null") * 100.0 / F.col("_n"), 4))
            .drop("_n"))


def describe_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles (linear), max per column."""
    spark = df.sparkSession
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
                 F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)]))
    stats = one.select(entries.alias("e")).select("e.*")
    qs = quantiles(df, cols, [0.25, 0.5, 0.75], kind="cont")
    qdf = spark.createDataFrame(
        [(c, qs.get(("", c, 0.25)), qs.get(("", c, 0.5)), qs.get(("", c, 0.75))) for c in cols],
        "column string, q25 double, q50 double, q75 double")
    return stats.join(F.broadcast(qdf), "column")  # one row per column


def value_counts(df: DataFrame, col: str, by: str = "count") -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col) if by == "count" else counts.orderBy(col)


def group_means(df: DataFrame, key: str, cols: list[str], digits: int = 2) -> DataFrame:
    return df.groupBy(key).agg(*[F.round(F.avg(c), digits).alias(c) for c in cols])


def crosstab_pct(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Row-normalised contingency table in percent; ``values`` fixes the
    pivot columns (no extra pass to discover them), empty cells are 0."""
    piv = df.groupBy(row).pivot(col, values).agg(F.count(F.lit(1))).na.fill(0)
    total = reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values])
    return piv.select(row, *[F.round(F.col(f"`{v}`") * 100.0 / total, 4).alias(_safe(v)) for v in values])


def _safe(v) -> str:
    return "p_" + "".join(ch if ch.isalnum() else "_" for ch in str(v))


def count_by_two(df: DataFrame, x: str, hue: str, order: list | None = None) -> DataFrame:
    out = df.groupBy(x, hue).agg(F.count(F.lit(1)).alias("n"))
    if order:
        pos = F.create_map(*[a for i, v in enumerate(order) for a in (F.lit(v), F.lit(i))])
        out = out.withColumn("x_order", pos[F.col(x)])
    return out


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max]; density = count / (n * width).
    Empty bins are present with count 0; a column without a value has none."""
    spark = df.sparkSession
    st = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    if not st.n:  # no value, no bins
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n bigint, density double")
    lo, hi, n = float(st.lo), float(st.hi), st.n
    w = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.lit(bins - 1), F.floor((F.col(col) - F.lit(lo)) / F.lit(w)).cast("int"))
    counts = df.where(F.col(col).isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(counts, "bin", "left").na.fill(0, ["n"])
    return out.select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(w)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(w)).alias("bin_hi"), "n",
        (F.col("n") / F.lit(n * w)).alias("density"))


def box_stats(df: DataFrame, group: str, col: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles (linear), whiskers = most extreme values inside the fences,
    outlier count, per group.  Quartiles are exact per group without a
    single-task merge (see ``quantiles``); the per-group table is joined back."""
    spark = df.sparkSession
    qs = quantiles(df, [col], [0.25, 0.5, 0.75], kind="cont", group=group)
    groups = sorted({g for g, _c, _q in qs})
    qdf = spark.createDataFrame(
        [(g, qs[(g, col, 0.25)], qs[(g, col, 0.5)], qs[(g, col, 0.75)]) for g in groups],
        "_g string, q1 double, median double, q3 double")
    qdf = qdf.withColumn("iqr", F.col("q3") - F.col("q1")) \
        .withColumn("fence_lo", F.col("q1") - whisker * F.col("iqr")) \
        .withColumn("fence_hi", F.col("q3") + whisker * F.col("iqr"))
    x = F.col(col)
    j = df.select(F.col(group).cast("string").alias("_g"), x).where(x.isNotNull()) \
        .join(broadcast_if_small(qdf), "_g")
    inside = x.between(F.col("fence_lo"), F.col("fence_hi"))
    agg = j.groupBy("_g", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, x)).alias("whisker_lo"), F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))
    return agg.withColumnRenamed("_g", group)


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """'balanced' weights n / (k * n_class), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_tot"), F.count(F.lit(1)).alias("_k"))
    return counts.withColumn("weight", F.lit(tot.select("_tot").scalar()) * 1.0 /
                             (tot.select("_k").scalar() * F.col("n")))


def join_class_weight(df: DataFrame, label: str, weights: DataFrame | None = None) -> DataFrame:
    weights = weights if weights is not None else class_weight_table(df, label)
    return df.join(broadcast_if_small(weights.select(label, "weight")), label)


def class_counts_min(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("min_count"))


def fold_stats(fold_scores: DataFrame, score: str = "score", by: list[str] | None = None) -> DataFrame:
    """Mean and population std of per-fold scores (numpy ``std``)."""
    g = fold_scores.groupBy(*(by or []))
    return g.agg(F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"),
                 F.count(F.lit(1)).alias("n_folds"))


def kde_curve(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on ``points`` grid points spanning [min, max]
    (the curve drawn over a histogram), bandwidth by Scott's rule
    (sample std * n^(-1/5)).  Exact: every grid point's density is one sum
    over all rows, and the ``points`` sums form one wide aggregate (partial
    sums per task, no join with the grid)."""
    import math
    spark = df.sparkSession
    st = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n"),
                F.stddev_samp(col).alias("sd")).first()
    lo, hi, n, sd = float(st.lo), float(st.hi), st.n, float(st.sd or 0.0)
    h = sd * n ** (-0.2) if sd > 0 else 1.0
    step = (hi - lo) / (points - 1) if points > 1 else 0.0
    grid = [lo + i * step for i in range(points)]
    x = F.col(col)
    sums = df.where(x.isNotNull()).agg(*[
        F.sum(F.exp(-0.5 * F.pow((F.lit(g) - x) / F.lit(h), 2))).alias(f"k{i}") for i, g in enumerate(grid)])
    denom = n * h * math.sqrt(2 * math.pi)
    entries = F.explode(F.array(*[
        F.struct(F.lit(i).alias("point"), F.lit(g).alias("x"), (F.col(f"k{i}") / F.lit(denom)).alias("density"))
        for i, g in enumerate(grid)]))
    return sums.select(entries.alias("e")).select("e.*")
