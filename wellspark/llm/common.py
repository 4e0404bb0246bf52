"""Small helpers shared by the training-text operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.session import ensure_checkpoint_dir, text_batches  # noqa: F401


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(k)


def held_out(id_col: str, k: int, r: int) -> Column:
    """True where the fold is ``r``; a null id is held out (never learned from)."""
    return F.coalesce(fold(id_col, k) == r, F.lit(True))


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint(df: DataFrame) -> DataFrame:
    """Written once to the shared folder named by ``spark.checkpoint.dir``.

    The shuffle files behind it go at once, as nothing reads them again: an
    iterative job would else keep those of all its rounds until the driver
    happens to collect garbage."""
    conf = df.sparkSession.conf
    ensure_checkpoint_dir(df.sparkSession)
    before = conf.get(CLEAN)
    conf.set(CLEAN, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        conf.set(CLEAN, before)


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a written intermediate that no later job reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Deal rows by ``cols`` into the session's shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def slices(sizes: Iterable[int], budget: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes sum to at most ``budget`` (a single
    larger row is a range of its own): bounds a task's memory, drops nothing."""
    start = total = n = 0
    for i, s in enumerate(sizes):
        if i > start and total + s > budget:
            yield start, i
            start, total = i, 0
        total += s
        n = i + 1
    if n > start:
        yield start, n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, k: int, r: int, per_class: int,
                    max_chars: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y, weight): at most ``per_class`` labelled rows of each class
    whose crc32 fold is not ``r``, those with the smallest hash of the id.

    ``weight`` undoes the sampling: rows of the class in the fold over rows
    taken.  Rows with a null id, label or text, with a label other than 0 and 1
    or with more than ``max_chars`` characters are not learned from; repeated
    label rows count once.
    """
    spark = docs.sparkSession
    ids = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
           .where(F.col("id").isNotNull() & F.col("y").isin(0, 1) & (F.crc32(F.col("id").cast("string").cast("binary")) % k != r))
           .groupBy("id").agg(F.max("y").alias("y")).withColumn("h", F.xxhash64("id")))
    share = {row["y"]: row["n"] for row in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    taken = None
    for y in (0, 1):
        part = ids.where(F.col("y") == y).orderBy("h", "id").limit(per_class)
        taken = part if taken is None else taken.unionByName(part)
    weight = F.lit(1.0)
    for y, n in share.items():
        weight = F.when(F.col("y") == y, F.lit(max(1.0, n / per_class))).otherwise(weight)
    # at most 2 x per_class rows of three numbers: bounded, so it may be broadcast
    found = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(
        F.col("text").isNotNull() & (F.char_length("text") <= max_chars))
    return found.join(F.broadcast(taken), "id").withColumn("weight", weight).select("id", "text", "y", "weight", "h")


def fit_logistic(x, y, w, l2: float = 1e-3, steps: int = 60):
    """Weighted logistic regression by Newton steps; returns coefficients with
    the intercept last.  One class only: the intercept of that class."""
    import numpy as np

    x = np.c_[np.asarray(x, float), np.ones(len(y))]
    y, w = np.asarray(y, float), np.asarray(w, float)
    beta = np.zeros(x.shape[1])
    if not len(y):
        return beta
    w = w / w.sum() * len(w)
    ridge = np.full(len(beta), l2 * len(y))
    ridge[-1] = 1e-6 * len(y)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
        grad = x.T @ (w * (p - y)) + ridge * beta
        hess = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def sigmoid(z):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


BROADCAST_IDS = 1_000_000  # ids of 8 bytes; more are joined by a shuffle


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is not among ``ids`` (a null id never is)."""
    ids = checkpoint(ids.select(F.col(ids.columns[0]).alias(id_col)).where(F.col(id_col).isNotNull()).distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, id_col, "left_anti").select(*docs.columns)


def one_row_each(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row of every id that has several; rows with a null id all stay."""
    again = checkpoint(docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias("c"))
                       .where("c > 1").select(id_col))
    if again.isEmpty():
        return docs
    several = docs.join(again, id_col, "left_semi").select(*docs.columns).dropDuplicates([id_col])
    return without(docs, again, id_col).unionByName(several)
