"""Sinks: CSV folders, staged publication, X/y datasets, fitted models and
parameters, the vector store.  Parquet is the default format; a single part
file is produced only when the caller asks for it (``coalesce(1)`` would
otherwise serialise the last stage)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def write_csv_dir(df: DataFrame, path: str, single_file: bool = False, sep: str = ",") -> str:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def publish(df: DataFrame, final_path: str, fmt: str = "parquet", single_file: bool = False,
            partition_by: list[str] | None = None) -> str:
    """Write to ``<final>_temp``, rename an old dataset aside, rename the new
    one in, then delete the old: readers never see a half-written dataset, and
    a failure between the steps leaves the old or the new one whole."""
    spark = df.sparkSession
    staging = final_path.rstrip("/") + "_temp"
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(staging)
    else:
        w.format(fmt).save(staging)
    fs, final, jvm = _fs(spark, final_path)
    aside = jvm.org.apache.hadoop.fs.Path(final_path.rstrip("/") + "_old")
    if fs.exists(final):
        fs.delete(aside, True)  # of an earlier run that ended after its swap
        if not fs.rename(final, aside):
            raise OSError(f"rename {final_path} -> {aside} failed")
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(staging), final):
        fs.rename(aside, final)  # the old dataset stays
        raise OSError(f"rename {staging} -> {final_path} failed")
    fs.delete(aside, True)
    return final_path


def write_split_xy(train: DataFrame, test: DataFrame, id_col: str, features: list[str], label: str,
                   base: str) -> dict[str, str]:
    """X_train, X_test (id + features) and y_train, y_test (id + label);
    the id lets X and y be joined again (no reliance on row position)."""
    paths = {}
    for name, df in (("train", train), ("test", test)):
        paths[f"X_{name}"] = f"{base}/X_{name}"
        paths[f"y_{name}"] = f"{base}/y_{name}"
        df.select(id_col, *features).write.mode("overwrite").parquet(paths[f"X_{name}"])
        df.select(id_col, label).write.mode("overwrite").parquet(paths[f"y_{name}"])
    return paths


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_params(params: DataFrame, path: str) -> str:
    params.write.mode("overwrite").parquet(path)
    return path


def write_vectors(df: DataFrame, path: str) -> str:
    """Build the vector store once: ``mode('ignore')`` leaves an existing
    store untouched."""
    df.write.mode("ignore").parquet(path)
    return path
