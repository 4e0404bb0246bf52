"""Registered queries: sources and sinks (2.1).  Each writes below the
shared checkpoint folder and reads the result back, so the check covers the
round trip."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from wellspark.operators.clean import Imputation
from wellspark.operators.encode import ZScore
from wellspark.plans.fixtures import (SURVEY_LINEITEM_SQL, split_col, split_sql,
                                      survey_lineitem)
from wellspark.plans.registry import register
from wellspark.session import scratch_path
from wellspark.sources import sinks as SK
from wellspark.sources.tables import read_csv, read_split_pair, read_text_documents, split_report, table

S = "sources"


def _tmp(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("src_csv", S, "SELECT * FROM customer")
def q_src_csv(spark, sf):
    c = table(spark, sf, "customer")
    path = SK.write_csv_dir(c, _tmp(spark, "csv"))
    return read_csv(spark, path, c.schema)


@register("sink_csv_dir", S, "SELECT * FROM part")
def q_sink_csv_dir(spark, sf):
    p = table(spark, sf, "part")
    path = SK.write_csv_dir(p, _tmp(spark, "csvdir"))  # parallel parts; single_file=True on request
    return read_csv(spark, path, p.schema)


@register("src_split_pair", S, f"""
SELECT split, count(*) AS n_rows, CAST(6 AS INTEGER) AS n_cols FROM (SELECT {split_sql('o_orderkey')} AS split FROM orders)
GROUP BY 1""")
def q_src_split_pair(spark, sf):
    o = table(spark, sf, "orders")
    base = _tmp(spark, "pair")
    o.where(split_col("o_orderkey") == "train").write.parquet(f"{base}/train")
    o.where(split_col("o_orderkey") == "test").write.parquet(f"{base}/test")
    train, test = read_split_pair(spark, f"{base}/train", f"{base}/test")
    return split_report(train, test)


@register("src_text_doc", S, """
SELECT lang, CAST(sum(length(text) + 1) AS BIGINT) AS total_chars, count(*) AS n_docs FROM documents GROUP BY 1""")
def q_src_text_doc(spark, sf):
    d = table(spark, sf, "documents")
    path = _tmp(spark, "text")
    # one text file per (lang, task); documents separated by a newline
    d.select("lang", "text").write.partitionBy("lang").text(path)
    files = read_text_documents(spark, path).withColumn(
        "lang", F.regexp_extract("source", r"lang=([^/]+)", 1))
    counts = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
    return files.groupBy("lang").agg(F.sum(F.length("text")).cast("bigint").alias("total_chars")) \
        .join(counts, "lang")


@register("sink_publish", S, "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem")
def q_sink_publish(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    final = SK.publish(li, _tmp(spark, "published"))
    return spark.read.parquet(final)


@register("sink_split_xy", S, f"""
SELECT o_orderkey, {split_sql('o_orderkey')} AS split, o_totalprice, o_orderpriority FROM orders""")
def q_sink_split_xy(spark, sf):
    o = table(spark, sf, "orders")
    train = o.where(split_col("o_orderkey") == "train")
    test = o.where(split_col("o_orderkey") == "test")
    paths = SK.write_split_xy(train, test, "o_orderkey", ["o_totalprice"], "o_orderpriority", _tmp(spark, "xy"))
    parts = []
    for name in ("train", "test"):
        x = spark.read.parquet(paths[f"X_{name}"])
        y = spark.read.parquet(paths[f"y_{name}"])
        parts.append(x.join(y, "o_orderkey").withColumn("split", F.lit(name)))
    return parts[0].unionByName(parts[1]).select("o_orderkey", "split", "o_totalprice", "o_orderpriority")


@register("sink_model", S)
def q_sink_model(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="o_orderstatus", outputCol="label"),
        StringIndexer(inputCol="o_orderpriority", outputCol="prio"),
        VectorAssembler(inputCols=["prio", "o_totalprice"], outputCol="features"),
        LogisticRegression(maxIter=50)])
    model = pipe.fit(o)
    path = SK.save_model(model, _tmp(spark, "model"))
    again = SK.load_model(path)
    a = model.transform(o).select("o_orderkey", F.col("prediction").alias("before"))
    b = again.transform(o).select("o_orderkey", F.col("prediction").alias("after"))
    return a.join(b, "o_orderkey").withColumn("same", F.col("before") == F.col("after"))


_LI_SPLIT = split_sql("l_orderkey")


@register("sink_fitted_params", S, f"""
WITH t AS (SELECT * FROM {SURVEY_LINEITEM_SQL} WHERE {_LI_SPLIT} = 'train')
SELECT 'median' AS param, 'qty' AS "column", round(quantile_cont(qty, 0.5), 6) AS value, NULL::VARCHAR AS text FROM t
UNION ALL SELECT 'mean', 'l_extendedprice', round(avg(l_extendedprice), 6), NULL FROM t
UNION ALL SELECT 'std', 'l_extendedprice', round(stddev_pop(l_extendedprice), 6), NULL FROM t""")
def q_sink_fitted_params(spark, sf):
    li = survey_lineitem(spark, sf)
    train = li.where(split_col("l_orderkey") == "train")
    imp = Imputation([], ["qty"], []).fit(train)
    z = ZScore(["l_extendedprice"]).fit(train)
    params = imp.params(spark).unionByName(z.params(spark))
    path = SK.write_params(params, _tmp(spark, "params"))
    back = spark.read.parquet(path)
    return back.select("param", "column", F.round("value", 6).alias("value"), "text")


@register("sink_vectors", S, "SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims FROM embeddings")
def q_sink_vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    path = _tmp(spark, "store")
    SK.write_vectors(e, path)
    SK.write_vectors(e.limit(0), path)  # second build is a no-op: the store exists
    return spark.read.parquet(path).select("vec_id", "label", F.size("embedding").alias("dims"))
