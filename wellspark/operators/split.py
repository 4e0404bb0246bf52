"""Splits, folds, balanced samples and seeded shuffles.

Randomness is a hash of a key (md5), never ``rand()``: the result does not
depend on partitioning or on task retries, and the SQL oracle can compute
the same thing.  Per-class cuts need the class size, which comes from a
grouped count (one row per class) joined back, not from a collect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspark.functions.columns import md5_bucket
from wellspark.operators.windows import group_row_number


def split_random(df: DataFrame, weights=(0.8, 0.2), seed: int = 22):
    """Spark's sampler split (depends on partitioning; kept for parity)."""
    return df.randomSplit(list(weights), seed)


def split_md5(df: DataFrame, key: str, train_pct: int = 80, salt: str = ""):
    """Stable split: bucket = md5(key) % 100, train if bucket < train_pct."""
    k = F.col(key).cast("string") if not salt else F.concat(F.col(key).cast("string"), F.lit(salt))
    b = md5_bucket(k)
    return df.where(b < train_pct), df.where(b >= train_pct)


def hash_order(key: str, seed: int | str = "") -> "F.Column":
    """Seeded pseudo-random order key: md5 of the key and the seed."""
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def _class_sizes(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))


_NULL_GROUP = "\u0000<null>"


def _order_value(key: str, seed) -> "F.Column":
    """Numeric order key exactly representable as a double: the first 13 hex
    digits (52 bits) of md5(key || seed), or the numeric key itself."""
    if seed is None:
        return F.col(key).cast("double")
    return F.conv(F.substring(hash_order(key, seed), 1, 13), 16, 10).cast("bigint").cast("double")


def first_rows_per_group(df: DataFrame, group: str | None, key: str, need_fn, seed=None,
                         order_value=None, tie_order=None) -> DataFrame:
    """The first ``need_fn(n_group)`` rows of every group in the order
    (md5(key || seed), key) -- or (key) without a seed -- without sorting a
    group in one task and without writing the data.

    The cut value of each group is an exact order statistic of a 52-bit
    numeric prefix of the order (scan-only passes, see ``quantiles``); rows
    strictly below it are kept, and only the rows tied at the cut (prefix
    collisions: a handful) are ranked by the full order.  Per-group tables
    have one row per group.  ``order_value`` (a double column, ascending) and
    ``tie_order`` (columns) replace the md5 order, e.g. ``-count`` then
    ``term`` for a top-k by count; ``group=None`` is one group."""
    from wellspark.operators.profile import broadcast_if_small
    from wellspark.operators.quantiles import order_statistics
    spark = df.sparkSession
    g = F.coalesce(F.col(group).cast("string"), F.lit(_NULL_GROUP)) if group else F.lit("")
    o = order_value.cast("double") if order_value is not None else _order_value(key, seed)
    keyed = df.withColumn("_g", g).withColumn("_o", o)
    counts, stats = order_statistics(keyed, ["_o"], lambda n: [max(0, min(need_fn(n), n) - 1)], group="_g")
    cuts = []
    for (gv, _c), n in counts.items():
        need = min(need_fn(n), n)
        if need > 0:
            cuts.append((gv, float(stats[(gv, "_o", need - 1)]), int(need)))
    if not cuts:
        return df.limit(0)
    cut_df = broadcast_if_small(spark.createDataFrame(cuts, "_g string, _t double, _need bigint"))
    j = keyed.join(cut_df, "_g")
    below = j.where(F.col("_o") < F.col("_t")).groupBy("_g").agg(F.count(F.lit(1)).alias("_below"))
    ties = j.where(F.col("_o") == F.col("_t")).join(below, "_g", "left") \
        .withColumn("_below", F.coalesce("_below", F.lit(0)))
    if tie_order is not None:
        full = list(tie_order)
    else:
        full = [hash_order(key, seed), F.col(key)] if seed is not None else [F.col(key)]
    w = Window.partitionBy("_g").orderBy(*full)
    chosen = ties.withColumn("_r", F.row_number().over(w)) \
        .where(F.col("_r") <= F.col("_need") - F.col("_below")).select("_g", F.col(key).alias("_k"))
    keep = j.join(broadcast_if_small(chosen), (j["_g"] == chosen["_g"]) & (j[key] == chosen["_k"]), "left") \
        .where((F.col("_o") < F.col("_t")) | F.col("_k").isNotNull())
    return keep.select(*[j[c] for c in df.columns])


def _ceil_frac(frac: float):
    """n -> ceil(n * frac) in exact decimal arithmetic (as SQL decimals)."""
    from fractions import Fraction
    f = Fraction(str(frac))
    return lambda n: -((-n * f.numerator) // f.denominator)


def split_stratified(df: DataFrame, key: str, label: str, test_frac: float = 0.2,
                     seed: int = 46) -> DataFrame:
    """Adds ``split`` ('train'/'test'): per class, the first
    ceil(test_frac * n) rows in seeded hash order go to test."""
    test = first_rows_per_group(df.select(key, label), label, key, _ceil_frac(test_frac), seed) \
        .select(F.col(key).alias("_tk"), F.lit(True).alias("_is_test"))
    out = df.join(test, df[key] == test["_tk"], "left")
    return out.withColumn("split", F.when(F.col("_is_test"), F.lit("test")).otherwise(F.lit("train"))) \
        .drop("_tk", "_is_test")


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Plain shuffled folds: fold = md5(key, seed) bucket % k.  No sort."""
    return df.withColumn("fold", F.pmod(F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10)
                                        .cast("bigint"), F.lit(k)).cast("int"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 46) -> DataFrame:
    """Each class dealt round-robin over k folds in seeded hash order, so every
    fold gets floor or ceil of n_class/k rows of each class."""
    ranked = group_row_number(df, label, [hash_order(key, seed), F.col(key)], out="_rn")
    return ranked.withColumn("fold", F.pmod(F.col("_rn") - 1, F.lit(k)).cast("int")).drop("_rn")


def balanced_head(df: DataFrame, label: str, order_col: str, by_hash_seed=None) -> DataFrame:
    """First m rows of every class, m = size of the smallest class.  With
    ``by_hash_seed`` the order inside a class is the seeded hash (an
    undersample) instead of source order."""
    m = _class_sizes(df, label).agg(F.min("_n")).first()[0] or 0
    return first_rows_per_group(df, label, order_col, lambda n: m, by_hash_seed)


def shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Seeded order that does not depend on partitioning (a range-partitioned
    global sort, so no single task holds all rows)."""
    return df.withColumn("_o", hash_order(key, seed)).orderBy("_o", key).drop("_o")
