"""Registered queries: streaming re-aims of the request path (2.18).  The
``events`` table is staged as files in a fresh stream folder, processed with
``trigger(availableNow=True)`` and the sink is read back."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from wellspark.functions.columns import std_text
from wellspark.operators import clean
from wellspark.plans.fixtures import split_col, split_sql
from wellspark.plans.registry import register
from wellspark.session import scratch_path
from wellspark.sources.tables import table
from wellspark.streaming import jobs

S = "streaming"


def _stage(spark, sf, files=4):
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex[:12]}")
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    # several files for several micro-batches; as many tasks as the input has
    ev.repartition(max(files, ev.rdd.getNumPartitions())).write.parquet(f"{base}/in")
    return base, ev


@register("stream_clean", S, f"""
WITH b AS (SELECT event_id, event_type, value, {split_sql('event_id')} AS split FROM events),
q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3 FROM b WHERE split = 'train'),
l AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT event_id, upper(trim(event_type, ' ')) AS event_type, value FROM b, l WHERE value BETWEEN lo AND hi""")
def q_stream_clean(spark, sf):
    base, ev = _stage(spark, sf)
    limits = clean.iqr_limits(ev.where(split_col("event_id") == "train"), 1.5, cols=["value"])
    s = jobs.file_stream(spark, f"{base}/in", ev.schema, max_files=1)
    cleaned = jobs.stream_clean(s, {"event_type": std_text(F.col("event_type"))}, clean.iqr_predicate(limits))
    jobs.run_to_files(cleaned.select("event_id", "event_type", "value"), f"{base}/out", f"{base}/ckpt")
    return spark.read.parquet(f"{base}/out")


@register("stream_score", S)
def q_stream_score(spark, sf):
    base, ev = _stage(spark, sf)
    model = Pipeline(stages=[
        StringIndexer(inputCol="event_type", outputCol="type_idx", handleInvalid="keep"),
        VectorAssembler(inputCols=["type_idx", "value"], outputCol="features"),
        KMeans(k=3, seed=46)]).fit(ev.where(split_col("event_id") == "train"))
    rules = {"event_type": F.col("event_type").isin("click", "view", "purchase", "signup"),
             "value": F.col("value").between(0, 400)}
    s = jobs.file_stream(spark, f"{base}/in", ev.schema, max_files=2)
    jobs.stream_score(s, rules, model, ["event_id"], f"{base}/valid", f"{base}/rejected", f"{base}/ckpt")
    valid = spark.read.parquet(f"{base}/valid").select("event_id", F.col("score").cast("string").alias("outcome"),
                                                      F.lit("scored").alias("status"))
    rej = spark.read.parquet(f"{base}/rejected").select("event_id", F.col("reject_reason").alias("outcome"),
                                                       F.lit("rejected").alias("status"))
    return valid.unionByName(rej)
