"""Registered queries: aggregations (2.5), windows (2.6), sorts and top-k
(2.7), set operations (2.8), splitting and sampling (2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellspark.operators import profile as P
from wellspark.operators import split as SP
from wellspark.operators.encode import ZScore
from wellspark.operators.windows import group_row_number
from wellspark.plans.fixtures import (SURVEY_LINEITEM_SQL,
                                      split_col, split_sql, survey_lineitem)
from wellspark.plans.registry import register
from wellspark.sources.tables import table

S = "profile"

_AUDIT_COLS = [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("qty", "double"),
               ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
               ("l_returnflag", "string"), ("l_linestatus", "string")]


@register("profile_audit", S, " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", '{t}' AS dtype,
  CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_null,
  CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct,
  round(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 4) AS pct_null
  FROM {SURVEY_LINEITEM_SQL}""" for c, t in _AUDIT_COLS))
def q_profile_audit(spark, sf):
    return P.profile_audit(survey_lineitem(spark, sf))


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("describe_numeric", S, " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, min({c}) AS min, max({c}) AS max,
  round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
  round(quantile_cont({c}, 0.75), 6) AS q75 FROM lineitem""" for c in _DESC_COLS))
def q_describe_numeric(spark, sf):
    d = P.describe_numeric(table(spark, sf, "lineitem"), _DESC_COLS)
    return d.select("column", "count", *[F.round(c, 6).alias(c) for c in ["mean", "std"]], "min", "max",
                    *[F.round(c, 6).alias(c) for c in ["q25", "q50", "q75"]])


@register("value_counts", S, "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def q_value_counts(spark, sf):
    return P.value_counts(table(spark, sf, "orders"), "o_orderpriority")


_MEAN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("group_means", S, "SELECT l_returnflag, " + ", ".join(
    f"round(avg({c}), 2) AS {c}" for c in _MEAN_COLS) + " FROM lineitem GROUP BY 1")
def q_group_means(spark, sf):
    return P.group_means(table(spark, sf, "lineitem"), "l_returnflag", _MEAN_COLS)


_PRIOS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("crosstab_pct", S, "SELECT o_orderstatus, " + ", ".join(
    f"round(count(*) FILTER (WHERE o_orderpriority = '{v}') * 100.0::DOUBLE / count(*), 4) AS "
    f"{P._safe(v)}" for v in _PRIOS) + " FROM orders GROUP BY 1")
def q_crosstab_pct(spark, sf):
    return P.crosstab_pct(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", _PRIOS)


_STATUS_ORDER = ["F", "O", "P"]


@register("count_by_two", S, """
SELECT o_orderstatus, o_orderpriority, count(*) AS n,
  CAST(CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS INTEGER) AS x_order
FROM orders GROUP BY 1, 2""")
def q_count_by_two(spark, sf):
    return P.count_by_two(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", _STATUS_ORDER)


@register("histogram", S, """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n FROM events),
w AS (SELECT lo, (hi - lo) / 20 AS w, n FROM s),
c AS (SELECT CAST(least(19, floor((value - lo) / w)) AS INTEGER) AS bin, count(*) AS n
      FROM events, w GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20))
SELECT g.bin, round(w.lo + g.bin * w.w, 6) AS bin_lo, round(w.lo + (g.bin + 1) * w.w, 6) AS bin_hi,
  coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / (w.n * w.w), 9) AS density
FROM g CROSS JOIN w LEFT JOIN c ON g.bin = c.bin""")
def q_histogram(spark, sf):
    h = P.histogram(table(spark, sf, "events"), "value", 20)
    return h.select("bin", F.round("bin_lo", 6).alias("bin_lo"), F.round("bin_hi", 6).alias("bin_hi"),
                    "n", F.round("density", 9).alias("density"))


@register("histogram_kde", S, """
WITH s AS (SELECT min(value) AS lo, max(value) AS hi, count(value) AS n, stddev_samp(value) AS sd FROM events),
p AS (SELECT lo, n, sd * pow(n, -0.2) AS h, (hi - lo) / 199 AS step FROM s),
g AS (SELECT CAST(range AS INTEGER) AS point, lo + range * step AS x FROM range(200), p)
SELECT g.point, round(g.x, 9) AS x,
  round(sum(exp(-0.5 * pow((g.x - e.value) / p.h, 2))) / (p.n * p.h * sqrt(2 * pi())), 12) AS density
FROM g, p, events e WHERE e.value IS NOT NULL GROUP BY g.point, g.x, p.n, p.h""")
def q_histogram_kde(spark, sf):
    k = P.kde_curve(table(spark, sf, "events"), "value", 200)
    return k.select("point", F.round("x", 9).alias("x"), F.round("density", 12).alias("density"))


@register("box_stats", S, """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1,
    quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3
  FROM lineitem GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT f.l_returnflag, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(iqr, 6) AS iqr,
  min(CASE WHEN l_extendedprice BETWEEN lo AND hi THEN l_extendedprice END) AS whisker_lo,
  max(CASE WHEN l_extendedprice BETWEEN lo AND hi THEN l_extendedprice END) AS whisker_hi,
  count(*) FILTER (WHERE NOT l_extendedprice BETWEEN lo AND hi) AS n_outliers, count(*) AS n
FROM lineitem JOIN f USING (l_returnflag) GROUP BY f.l_returnflag, q1, median, q3, iqr""")
def q_box_stats(spark, sf):
    b = P.box_stats(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice")
    return b.select("l_returnflag", *[F.round(c, 6).alias(c) for c in ["q1", "median", "q3", "iqr"]],
                    "whisker_lo", "whisker_hi", "n_outliers", "n")


_SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
_LI_SPLIT = split_sql("l_orderkey")


@register("scale_check", S, "WITH t AS (SELECT * FROM lineitem WHERE " + _LI_SPLIT + " = 'train'), "
          "p AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALE_COLS)
          + " FROM t) " + " UNION ALL ".join(
              f"""SELECT '{c}' AS "column", round(avg(({c} - m_{c}) / s_{c}), 2) + 0.0 AS mean,
  round(stddev_samp(({c} - m_{c}) / s_{c}), 2) + 0.0 AS std FROM t, p""" for c in _SCALE_COLS))
def q_scale_check(spark, sf):
    train = table(spark, sf, "lineitem").where(split_col("l_orderkey") == "train")
    z = ZScore(_SCALE_COLS).fit(train)
    scaled = z.transform(train)
    row = scaled.agg(*[F.struct(F.round(F.avg(c), 2) + 0.0, F.round(F.stddev_samp(c), 2) + 0.0).alias(c)
                       for c in _SCALE_COLS])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).getField("col1").alias("mean"),
                 F.col(c).getField("col2").alias("std")) for c in _SCALE_COLS])).alias("e")).select("e.*")


_DOCS_LBL = "(SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id))"


def _docs_lbl(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(
        table(spark, sf, "labels"), "doc_id")


@register("class_counts_min", S, "SELECT min(n) AS min_count FROM (SELECT lang, count(*) AS n FROM documents GROUP BY 1)")
def q_class_counts_min(spark, sf):
    return P.class_counts_min(table(spark, sf, "documents"), "lang")


@register("class_weight_table", S, """
SELECT o_orderpriority, count(*) AS n,
  round((SELECT count(*) FROM orders) * 1.0::DOUBLE / ((SELECT count(DISTINCT o_orderpriority) FROM orders) * count(*)), 9)
    AS weight FROM orders GROUP BY 1""")
def q_class_weight_table(spark, sf):
    w = P.class_weight_table(table(spark, sf, "orders"), "o_orderpriority")
    return w.withColumn("weight", F.round("weight", 9))


@register("join_class_weight", S, """
WITH w AS (SELECT o_orderpriority, (SELECT count(*) FROM orders) * 1.0::DOUBLE /
  ((SELECT count(DISTINCT o_orderpriority) FROM orders) * count(*)) AS weight FROM orders GROUP BY 1)
SELECT o_orderkey, o_orderpriority, round(weight, 9) AS weight FROM orders JOIN w USING (o_orderpriority)""")
def q_join_class_weight(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return P.join_class_weight(o, "o_orderpriority").withColumn("weight", F.round("weight", 9))


_FOLD_SQL = "(('0x' || substr(md5(CAST(event_id AS VARCHAR) || '42'), 1, 8))::BIGINT % 5)"


@register("fold_stats", S, f"""
SELECT round(avg(score), 6) AS mean_score, round(stddev_pop(score), 6) AS std_score, count(*) AS n_folds
FROM (SELECT CAST({_FOLD_SQL} AS INTEGER) AS fold, avg(value) AS score FROM events GROUP BY 1)""")
def q_fold_stats(spark, sf):
    ev = SP.kfold(table(spark, sf, "events"), "event_id", 5, 42)
    per_fold = ev.groupBy("fold").agg(F.avg("value").alias("score"))
    s = P.fold_stats(per_fold)
    return s.select(F.round("mean_score", 6).alias("mean_score"), F.round("std_score", 6).alias("std_score"),
                    "n_folds")


# -------------------------------------------------------------------- windows

@register("balanced_head", S, """
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
  FROM documents) WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))""")
def q_balanced_head(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return SP.balanced_head(d, "lang", "doc_id")


@register("undersample", S, """
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang
  ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS rn FROM documents)
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))""")
def q_undersample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return SP.balanced_head(d, "lang", "doc_id", by_hash_seed=42)


@register("union_classes", S, """
SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang
  ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS rn FROM documents)
WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang))""")
def q_union_classes(spark, sf):
    from functools import reduce
    d = table(spark, sf, "documents").select("doc_id", "lang")
    langs = [r.lang for r in d.select("lang").distinct().collect()]  # class names, bounded
    m = d.groupBy("lang").count().agg(F.min("count")).first()[0]
    parts = [SP.first_rows_per_group(d.where(F.col("lang") == lang), "lang", "doc_id", lambda n: m, 42)
             for lang in sorted(langs)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("stratified_folds", S, """
SELECT doc_id, lang, CAST((row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || '46'),
  doc_id) - 1) % 5 AS INTEGER) AS fold FROM documents""")
def q_stratified_folds(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return SP.stratified_folds(d, "doc_id", "lang", 5, 46)


@register("kfold", S, f"SELECT event_id, CAST({_FOLD_SQL} AS INTEGER) AS fold FROM events")
def q_kfold(spark, sf):
    return SP.kfold(table(spark, sf, "events").select("event_id"), "event_id", 5, 42)


@register("split_random", S, f"SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM orders")
def q_split_random(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    train, test = SP.split_md5(o, "o_orderkey", 80)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@register("split_stratified", S, """
SELECT doc_id, lang, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || '46'), doc_id) AS rn,
    count(*) OVER (PARTITION BY lang) AS n FROM documents)""")
def q_split_stratified(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    return SP.split_stratified(d, "doc_id", "lang", 0.2, 46)


# ----------------------------------------------------------------- sorts, sets

@register("top1_desc", S, """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_orderpriority LIMIT 1""")
def q_top1_desc(spark, sf):
    return P.value_counts(table(spark, sf, "orders"), "o_orderpriority").limit(1)


@register("head", S, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def q_head(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(5)


@register("shuffle", S, """
SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '42'), o_orderkey) AS pos
FROM orders""")
def q_shuffle(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return group_row_number(o, F.lit(0), [SP.hash_order("o_orderkey", 42), F.col("o_orderkey")], "pos")


@register("dedup_keep_order", S, """
SELECT user_id, min(event_id) AS first_event_id FROM events GROUP BY 1""")
def q_dedup_keep_order(spark, sf):
    ev = table(spark, sf, "events")
    return ev.groupBy("user_id").agg(F.min("event_id").alias("first_event_id"))


@register("distinct_labels", S, "SELECT DISTINCT o_orderpriority FROM orders ORDER BY 1")
def q_distinct_labels(spark, sf):
    return table(spark, sf, "orders").select("o_orderpriority").distinct().orderBy("o_orderpriority")
