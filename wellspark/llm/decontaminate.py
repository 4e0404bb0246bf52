"""Benchmark decontamination by size-partitioned MinHash containment search.

Sets are distinct five-word shingles (a shorter text is one shingle).  Documents
are partitioned by the power of two ``p`` that bounds their set's size; a set of
class ``p`` is sketched by its smallest hash in each of ``2**(p + b)`` bins, so
that a bin holds about as many shingles in a document of a hundred words as in
one of a million, and a short item is found in a long document.  ``b`` follows
from the smallest item so that a contained item shares no bin minimum with
probability 1e-4 at most.  Items are sketched once for every class.  Equal
(class, minimum) pairs are candidates; each is verified by exact containment:
``100 * common >= 80 * (shingles of the item)``.

All on DataFrame functions.  Defined results: null or empty texts and null ids
are in no pair; the pair of repeated rows is reported once, with the largest
containment; equal items are separate items; an item of fewer than five words
must be a whole text; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import checkpoint

CLASSES = 33  # sets of up to 2**32 shingles, more than a string can hold
BROADCAST_KEYS = 2_000_000  # sketch entries of 24 bytes; beyond, a shuffle join


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[ \t-\r]+"), lambda w: w != "")


def shingle_hashes(w: str, n: int) -> Column:
    """Distinct n-word shingle hashes, ascending, from the word hashes ``w``."""
    words = F.col(w)
    many = F.transform(F.sequence(F.lit(0), F.size(words) - n),
                       lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))
    few = F.array(F.xxhash64(words))
    return F.sort_array(F.array_distinct(F.when(F.size(words) >= n, many).when(F.size(words) > 0, few)
                                         .otherwise(F.array().cast("array<bigint>"))))


def with_shingles(df: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, s): the sorted shingle hashes of each text that has any."""
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .where("id IS NOT NULL AND text IS NOT NULL")
            .select("id", F.transform(word_list(F.col("text")), lambda w: F.xxhash64(w)).alias("w"))
            .where(F.size("w") > 0).select("id", shingle_hashes("w", n).alias("s")))


def bin_minima(s: Column, p: Column, b: int) -> Column:
    """The smallest hash of each of the 2**(p + b) bins of sorted hashes; a bin
    is a range of the leading bits, so it is a run of the sorted array."""
    bits = F.least(p + b, F.lit(62))

    def leading(x: Column) -> Column:
        return F.call_function("shiftrightunsigned", x, (64 - bits).cast("int"))

    return F.filter(s, lambda x, i: (i == 0) | (bits > 0) & (leading(x) != leading(F.get(s, i - 1))))


def extra_bits(smallest: int, share: float, miss: float = 1e-4) -> int:
    """b so that a set of ``smallest`` shingles contained by ``share`` misses
    all bin minima with probability of at most ``miss``."""
    need = max(1, math.ceil(smallest * share))
    b = 0
    while b < 20:
        load = 2.0 ** -b
        if (1 - (1 - math.exp(-load)) / load) ** need <= miss:
            break
        b += 1
    return b


def contained(docs: DataFrame, items: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id",
              item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(doc id, item id, ``n_common``, ``n_item``) of every contained item."""
    item = checkpoint(with_shingles(items, item_col, text_col, n).withColumnRenamed("id", "item"))
    least = item.agg(F.min(F.size("s")).alias("n")).first()["n"]
    b = extra_bits(least or 1, percent / 100)
    keys = (item.select("item", "s", F.explode(F.sequence(F.lit(0), F.lit(CLASSES - 1))).alias("p"))
            .select("item", "p", F.explode(bin_minima(F.col("s"), F.col("p"), b)).alias("h")))
    keys = checkpoint(keys.groupBy("p", "h").agg(F.collect_set("item").alias("items")))
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)

    size_class = F.greatest(F.lit(0), F.ceil(F.log2(F.size("s").cast("double")))).cast("int")
    sketch = (with_shingles(docs, id_col, text_col, n).withColumn("p", size_class)
              .select("id", "p", F.explode(bin_minima(F.col("s"), F.col("p"), b)).alias("h")))
    pairs = checkpoint(sketch.join(keys, ["p", "h"]).select("id", F.explode("items").alias("item")).distinct())

    wanted = pairs.select(F.col("id").alias(id_col)).distinct()
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    typed = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias(text_col))
    full = with_shingles(typed.join(wanted, id_col, "left_semi"), id_col, text_col, n).distinct()
    common = F.size(F.array_intersect("si", "s"))
    return (pairs.join(item.withColumnRenamed("s", "si"), "item").join(full, "id")
            .select("id", "item", common.cast("long").alias("n_common"), F.size("si").cast("long").alias("n_item"))
            .where(F.col("n_common") * 100 >= F.col("n_item") * percent)
            .groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col))
            .agg(F.max("n_common").alias("n_common"), F.max("n_item").alias("n_item")))
