"""Readers for the Parquet test tables and for raw CSV / text inputs."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             sep: str = ",", header: bool = True) -> DataFrame:
    """Headed CSV.  With a schema there is no inference pass over the data;
    malformed rows are kept (PERMISSIVE) with their raw text in
    ``_corrupt_record`` when the schema asks for that column."""
    reader = spark.read.option("header", header).option("sep", sep).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
        if "_corrupt_record" in schema.fieldNames():
            reader = reader.option("columnNameOfCorruptRecord", "_corrupt_record")
    else:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_split_pair(spark: SparkSession, train_path: str, test_path: str,
                    fmt: str = "parquet", schema: StructType | None = None):
    """Train and test halves of a processed dataset, same schema for both."""
    def _load(p):
        if fmt == "csv":
            return read_csv(spark, p, schema)
        return spark.read.schema(schema).parquet(p) if schema else spark.read.parquet(p)
    return _load(train_path), _load(test_path)


def split_report(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and columns of each half in one job (a tagged union, one count)."""
    tagged = train.select(F.lit("train").alias("split")).unionByName(
        test.select(F.lit("test").alias("split")))
    counts = tagged.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("n_cols", F.lit(len(train.columns)).cast("int"))


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each file becomes one row: (source, text).  ``wholetext`` keeps a file in
    one row; files are spread over tasks, never concatenated on the driver."""
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")))
