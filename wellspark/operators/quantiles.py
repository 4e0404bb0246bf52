"""Exact order statistics without a global sort or a single-task merge.

Spark's exact ``percentile`` merges every distinct value of a group into one
task, and ``approxQuantile(.., 0.0)`` ships all samples to the driver; both
break at scale.  Here each pass is one scan with a small aggregate, the same at
every size:

1. pass 0: counts of finite values and of both infinities, and the finite
   minimum and maximum, per (group, column);
2. each later pass deals the values in a target's current range into
   ``buckets`` bins, counts them, sums the counts up to the wanted rank in Spark
   and reads back one row per target: the bin that holds the rank, with its
   count, minimum and maximum, which are the next range;
3. a target is done when its bin holds one distinct value, or when the rank is
   the first or the last of the bin.

Bins have equal width; where that left most values in one bin, the next pass
cuts the range on a logarithmic scale, so neither far outliers nor values spread
over many magnitudes add more than a few passes.  A value shared by a third of
all rows ends the search at once.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


TARGETS = 10_000  # of a pass, each about 100 bytes; more are taken in turn


def _long(df: DataFrame, cols: list[str], group: str | None) -> DataFrame:
    """(g, column index, x) rows; the column travels as a small int."""
    gcol = F.col(group).cast("string") if group else F.lit("")
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i).alias("column"), F.col(c).cast("double").alias("x")) for i, c in enumerate(cols)]))
    return (df.select(gcol.alias("g"), pairs.alias("p"))
            .select("g", "p.column", "p.x")
            .where(F.col("x").isNotNull() & ~F.isnan("x")))


_RANGES = T.StructType([
    T.StructField("tid", T.IntegerType()), T.StructField("g", T.StringType()),
    T.StructField("column", T.IntegerType()), T.StructField("rank", T.LongType()),
    T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType()),
    T.StructField("half", T.DoubleType()), T.StructField("unit", T.DoubleType())])


def _range(tid: int, t: dict) -> tuple:
    """A target's row: ``half`` keeps a range wider than the largest double
    finite, ``unit`` > 0 asks for bins on a logarithmic scale."""
    half = 0.5 if math.isinf(t["hi"] - t["lo"]) else 1.0
    unit = max(abs(t["lo"]), abs(t["hi"])) * 1e-290 if t["uneven"] else 0.0
    return tid, t["g"], t["column"], t["rank"], t["lo"], t["hi"], half, max(unit, 5e-324) if t["uneven"] else 0.0


def _scaled(x):
    """Where a value lies on the target's scale (monotonic in the value)."""
    return F.when(F.col("unit") > 0, F.signum(x) * F.log1p(F.least(F.abs(x) / F.col("unit"), F.lit(1.7e308)))).otherwise(x * F.col("half"))


def _narrowed(long_df: DataFrame, ranges: DataFrame, buckets: int) -> DataFrame:
    """One row per target: the bin holding the rank, and the rows before it.
    ``ranges`` has at most ``TARGETS`` rows, so the values never move to meet it."""
    near = long_df.join(F.broadcast(ranges), ["g", "column"]).where(F.col("x").between(F.col("lo"), F.col("hi")))
    low, high = _scaled(F.col("lo")), _scaled(F.col("hi"))
    part = F.when(F.col("x") == F.col("hi"), 1.0).when(F.col("x") == F.col("lo"), 0.0).otherwise(
        F.coalesce(F.try_divide(_scaled(F.col("x")) - low, high - low), F.lit(0.0)))
    bins = (near.select("tid", "rank", "x", F.least(F.lit(buckets - 1), F.greatest(F.lit(0), F.floor(part * buckets))).alias("b"))
            .groupBy("tid", "rank", "b").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("mn"), F.max("x").alias("mx")))
    # at most ``buckets`` rows of a target meet in its window
    of_target = Window.partitionBy("tid")
    upto = of_target.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    return (bins.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn("all", F.sum("n").over(of_target))
            .where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n"))))


def order_statistics(df: DataFrame, cols: list[str], ranks_fn, group: str | None = None, buckets: int = 1024):
    """Exact values at requested 0-based ranks.

    ``ranks_fn(n) -> list[int]`` gives the ranks wanted for a column of ``n``
    values that are neither null nor NaN.  Returns
    ``({(g, col): n}, {(g, col, rank): value})``; the driver holds no more than
    these, and reads one row per open target and pass.
    """
    spark = df.sparkSession
    long_df = _long(df, cols, group)
    inf = float("inf")
    finite = F.when(F.abs("x") < inf, F.col("x"))
    stats = long_df.groupBy("g", "column").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") == -inf).alias("below"), F.count(finite).alias("fin"),
        F.min(finite).alias("lo"), F.max(finite).alias("hi")).collect()
    counts, result, targets = {}, {}, {}
    for r in stats:
        name = cols[r.column]
        counts[(r.g, name)] = r.n
        for rank in {min(max(k, 0), r.n - 1) for k in ranks_fn(r.n)}:
            at = rank - r.below
            if at < 0 or at >= r.fin:
                result[(r.g, name, rank)] = -inf if at < 0 else inf
            elif r.lo == r.hi or at in (0, r.fin - 1):
                result[(r.g, name, rank)] = r.lo if at == 0 else r.hi
            else:
                targets[len(targets)] = dict(g=r.g, column=r.column, key=(r.g, name, rank), rank=at, lo=r.lo, hi=r.hi, uneven=False)
    values = long_df.where(F.abs("x") < inf)
    while targets:
        block = list(targets.items())[:TARGETS]
        ranges = spark.createDataFrame([_range(i, t) for i, t in block], _RANGES)
        for h in _narrowed(values, ranges, buckets).collect():
            t = targets[h.tid]
            at = t["rank"] - h.before
            if h.mn == h.mx or at in (0, h.n - 1):
                result[t["key"]] = h.mn if at == 0 else h.mx
                del targets[h.tid]
            else:
                t.update(rank=at, lo=h.mn, hi=h.mx, uneven=not t["uneven"] and 2 * h.n > h["all"])
    return counts, result


def disc_rank(q: float, n: int) -> int:
    """0-based rank of the discrete quantile (smallest value with cume_dist >= q)."""
    return max(int(math.ceil(q * n - 1e-12)) - 1, 0)


def quantiles(df: DataFrame, cols: list[str], probs: list[float], kind: str = "disc",
              group: str | None = None, rel_err: float | None = None) -> dict:
    """``{(g, col, q): value}`` for every column and probability.

    ``kind='disc'`` = SQL ``percentile_disc`` / ``approxQuantile(.., 0)``;
    ``kind='cont'`` = linear interpolation (``percentile`` / ``quantile_cont``).
    ``rel_err > 0`` switches to one-pass Greenwald-Khanna (``approxQuantile``),
    ungrouped only.
    """
    if rel_err:
        if group:
            raise ValueError("approximate grouped quantiles: use percentile_approx in an agg")
        vals = df.approxQuantile(cols, probs, rel_err)
        return {("", c, q): (vs[i] if vs else None)
                for c, vs in zip(cols, vals) for i, q in enumerate(probs)}

    def ranks(n):
        out = []
        for q in probs:
            if kind == "disc":
                out.append(disc_rank(q, n))
            else:
                h = q * (n - 1)
                out += [int(math.floor(h)), int(math.ceil(h))]
        return out

    counts, stats = order_statistics(df, cols, ranks, group)
    out = {}
    for (g, c), n in counts.items():
        for q in probs:
            if kind == "disc":
                out[(g, c, q)] = stats[(g, c, min(disc_rank(q, n), n - 1))]
            else:
                h = q * (n - 1)
                lo, hi = int(math.floor(h)), int(math.ceil(h))
                a, b = stats[(g, c, lo)], stats[(g, c, hi)]
                out[(g, c, q)] = a + (h - lo) * (b - a)
    return out
