"""Structured Streaming jobs: the batch cleaning and scoring re-used on
arriving files.

Both jobs are stateless maps over micro-batches, so they need no watermark.
Fitted constants and models are computed once in batch and carried into the
stream (literals / a ``PipelineModel``).  Output is exactly-once: the file
sink is transactional per batch, and ``foreachBatch`` writes each batch into
its own ``batch=<id>`` folder with overwrite, so a replayed batch replaces
its own output instead of duplicating it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wellspark.operators.requests import score_requests
from wellspark.operators.score import validate


def file_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_to_files(stream: DataFrame, sink: str, checkpoint: str, available_now: bool = True):
    q = (stream.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle


def stream_clean(stream: DataFrame, exprs: dict[str, Column], keep: Column) -> DataFrame:
    """Fitted cleaning expressions and the row filter, as in batch."""
    return stream.withColumns(exprs).where(keep)


def stream_score(stream: DataFrame, rules: dict[str, Column], model, keep_cols: list[str],
                 valid_sink: str, reject_sink: str, checkpoint: str, available_now: bool = True):
    """Validate every arriving row; score the valid ones with a fitted model
    and send the rejected ones, with their reasons, to a side table."""
    def per_batch(batch: DataFrame, batch_id: int):
        checked = validate(batch, rules)
        valid = checked.where("is_valid").drop("is_valid", "reject_reason")
        scored = model.transform(valid).select(*keep_cols, F.col("prediction").alias("score"))
        scored.write.mode("overwrite").parquet(f"{valid_sink}/batch={batch_id}")
        checked.where(~F.col("is_valid")).select(*keep_cols, "reject_reason") \
            .write.mode("overwrite").parquet(f"{reject_sink}/batch={batch_id}")

    q = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    handle = q.start()
    if available_now:
        handle.awaitTermination()
    return handle


def stream_requests(stream: DataFrame, model, keys: list[str], valid_sink: str, reject_sink: str,
                    checkpoint: str, available_now: bool = True):
    """Raw request rows through a request model (``operators.requests``): scores
    to one table, rejected rows with their reasons to another."""
    def per_batch(batch: DataFrame, batch_id: int):
        scored, rejected = score_requests(model, batch, keys)
        scored.write.mode("overwrite").parquet(f"{valid_sink}/batch={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{reject_sink}/batch={batch_id}")

    q = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    handle = (q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")).start()
    if available_now:
        handle.awaitTermination()
    return handle
