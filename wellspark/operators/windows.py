"""Row numbers within a group that do not put a hot group in one task.

``row_number().over(partitionBy(g).orderBy(o))`` sorts each group inside a
single task; a class holding a third of all rows would then be sorted by one
executor.  Here the rows are range-partitioned on (g, o) -- a large group is
spread over many partitions -- and each row's number is

    rows of g in earlier partitions + position of the row inside its partition

The per-(partition, group) counts form a table with about
partitions + groups rows, the only thing that crosses partitions.  The sorted
frame is checkpointed (reliably, into ``spark.checkpoint.dir``) so both uses
of it see the same partitions, also after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.session import cut_lineage

_LOCAL_BITS = 33


def group_row_number(df: DataFrame, group: str | Column, order: list, out: str = "rn",
                     partitions: int | None = None) -> DataFrame:
    """Adds ``out`` = 1-based row number of each row inside its group in the
    given order (ties must be broken by the caller's order columns)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    g = F.col(group) if isinstance(group, str) else group
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    # Nulls become one sentinel group so the join back can use plain equality.
    keyed = df.withColumn("_g", F.coalesce(g.cast("string"), F.lit("\u0000<null>")))
    for i, o in enumerate(order_cols):
        keyed = keyed.withColumn(f"_o{i}", o)
    okeys = [F.col(f"_o{i}") for i in range(len(order_cols))]
    ranged = keyed.repartitionByRange(n, F.col("_g"), *okeys).sortWithinPartitions(F.col("_g"), *okeys)
    mid = F.monotonically_increasing_id()
    fixed = cut_lineage(ranged.withColumn("_mid", mid))
    fixed = (fixed.withColumn("_pid", F.shiftright("_mid", _LOCAL_BITS))
             .withColumn("_loc", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))))
    blocks = fixed.groupBy("_pid", "_g").agg(F.count(F.lit(1)).alias("_cnt"),
                                             F.min("_loc").alias("_first"))
    before = F.coalesce(F.sum("_cnt").over(
        Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.withColumn("_before", before).select("_pid", "_g", "_before", "_first")
    res = fixed.join(blocks, ["_pid", "_g"])
    res = res.withColumn(out, (F.col("_before") + F.col("_loc") - F.col("_first") + 1).cast("bigint"))
    drop = ["_g", "_mid", "_pid", "_loc", "_before", "_first"] + [f"_o{i}" for i in range(len(order_cols))]
    return res.drop(*drop)


def cumulative_sums(df: DataFrame, order: list, sum_cols: list[str], descending: bool = False,
                    partitions: int | None = None) -> DataFrame:
    """Running totals of ``sum_cols`` in a global order, without a window over
    one partition: range-partition on the order, total each partition (a
    table of ``partitions`` rows), offset every partition by the totals of
    the partitions before it, and run the window inside each partition."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    okeys = [(F.col(o) if isinstance(o, str) else o) for o in order]
    okeys = [o.desc() if descending else o.asc() for o in okeys]
    ranged = df.repartitionByRange(n, *okeys).withColumn("_pid", F.spark_partition_id())
    fixed = cut_lineage(ranged)
    totals = fixed.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    w_prev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(w_prev), F.lit(0)).alias(f"_off_{c}")
                                      for c in sum_cols])
    w_in = Window.partitionBy("_pid").orderBy(*okeys).rowsBetween(Window.unboundedPreceding, 0)
    out = fixed.join(F.broadcast(offsets), "_pid")  # one row per partition: bounded
    out = out.withColumns({f"cum_{c}": F.sum(c).over(w_in) + F.col(f"_off_{c}") for c in sum_cols})
    return out.drop("_pid", *[f"_off_{c}" for c in sum_cols])
