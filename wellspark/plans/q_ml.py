"""Registered queries: neighbours (2.4, 2.10), evaluation (2.15), encoders
(2.11) -- the parts with an exact SQL oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellspark.operators import encode as EN
from wellspark.operators import evaluate as EV
from wellspark.operators import neighbors as NB
from wellspark.plans.fixtures import split_col, split_sql
from wellspark.plans.registry import register
from wellspark.sources.tables import table

S = "ml"

_EMB_SQL = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"


def _emb(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"), "label")


def _knn_sql(k: int, where: str = "a.vec_id <> b.vec_id", a_src: str = _EMB_SQL, b_src: str = _EMB_SQL,
             dist: str = "list_distance(a.v, b.v)") -> str:
    return f"""(SELECT qid, nid, label, dist, rank FROM (
  SELECT a.vec_id AS qid, b.vec_id AS nid, b.label, {dist} AS dist,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY {dist}, b.vec_id) AS rank
  FROM {a_src} a JOIN {b_src} b ON {where}) WHERE rank <= {k})"""


# ------------------------------------------------------------------ neighbours

@register("join_nearest", S, f"""
SELECT qid, nid, CAST(rank AS INTEGER) AS rank, round(dist, 6) AS dist FROM {_knn_sql(5)}""")
def q_join_nearest(spark, sf):
    e = _emb(spark, sf)
    nn = NB.knn(e, e, 5, "vec_id", "vec_id", "vec", exclude_self=True)
    return nn.select("qid", "nid", "rank", F.round("dist", 6).alias("dist"))


_EMB_TRAIN = f"(SELECT * FROM {_EMB_SQL} WHERE {split_sql('vec_id')} = 'train')"
_EMB_TEST = f"(SELECT * FROM {_EMB_SQL} WHERE {split_sql('vec_id')} = 'test')"


@register("fit_knn", S, f"""
WITH nn AS {_knn_sql(5, 'true', _EMB_TEST, _EMB_TRAIN, 'list_sum(list_transform(list_zip(a.v, b.v), lambda p: abs(p[1] - p[2])))')},
v AS (SELECT qid, label, count(*) AS votes FROM nn GROUP BY 1, 2)
SELECT qid, arg_min(label, struct_pack(nv := -votes, l := label)) AS predicted FROM v GROUP BY 1""")
def q_fit_knn(spark, sf):
    e = _emb(spark, sf).withColumn("split", split_col("vec_id"))
    train, test = e.where("split = 'train'"), e.where("split = 'test'")
    nn = NB.knn(test, train, 5, "vec_id", "vec_id", "vec", metric="manhattan", carry=["label"])
    return NB.knn_vote(nn, "label")


_NORM_SQL = """(SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v,
  label FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings))"""


@register("join_vector_topk", S, f"""
SELECT qid, nid, CAST(rank AS INTEGER) AS rank, round(1 - dist * dist / 2, 6) AS cosine
FROM {_knn_sql(10, 'true', _NORM_SQL, _NORM_SQL)}""")
def q_join_vector_topk(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", NB.normalize("embedding").alias("vec"))
    nn = NB.knn(e, e, 10, "vec_id", "vec_id", "vec")
    return nn.select("qid", "nid", "rank", F.round(1 - F.col("dist") * F.col("dist") / 2, 6).alias("cosine"))


_BIN_SQL = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, CASE WHEN label = 0 THEN 1 ELSE 0 END AS label FROM embeddings)"


@register("tomek_links", S, f"""
WITH e AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[64]) AS v, label = 0 AS label FROM embeddings),
nn AS MATERIALIZED (SELECT a.vec_id AS qid, a.label, min(struct_pack(d := array_distance(a.v, b.v), i := b.vec_id)).i AS nid
    FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY 1, 2)
SELECT x.qid AS id_a, x.nid AS id_b FROM nn x JOIN nn y ON x.qid = y.nid AND x.nid = y.qid
WHERE x.label <> y.label AND x.qid < x.nid""")
def q_tomek_links(spark, sf):
    e = _emb(spark, sf).withColumn("label", (F.col("label") == 0).cast("int"))
    return NB.tomek_links(e, "vec_id", "vec", "label")


@register("smote", S)
def q_smote(spark, sf):
    e = _emb(spark, sf).withColumn("label", (F.col("label") == 0).cast("int"))
    return NB.smote(e, "vec_id", "vec", "label", minority=1, ratio=0.5, k=5, seed=46)


@register("smote_tomek", S)
def q_smote_tomek(spark, sf):
    """The rebalanced training rows: SMOTE to half of the majority, then both
    rows of every Tomek link removed."""
    e = _emb(spark, sf).withColumn("label", (F.col("label") == 0).cast("int"))
    train = e.where(split_col("vec_id") == "train")
    return NB.smote_tomek(train, "vec_id", "vec", "label", minority=1, ratio=0.5, k=5, seed=46)


@register("knn_visits", S)
def q_knn_visits(spark, sf):
    """Cells that each query of the exact search visits."""
    e = _emb(spark, sf)
    return NB.knn(e, e, 5, "vec_id", "vec_id", "vec", exclude_self=True, visits=True)


# ------------------------------------------------------------------ evaluation

_PRED_SQL = """(SELECT o_orderkey, o_orderpriority AS label, CASE WHEN o_totalprice < 100000 THEN '1-URGENT'
  WHEN o_totalprice < 200000 THEN '2-HIGH' WHEN o_totalprice < 300000 THEN '3-MEDIUM'
  WHEN o_totalprice < 400000 THEN '4-NOT SPECIFIED' ELSE '5-LOW' END AS prediction FROM orders)"""


def _pred(spark, sf):
    o = table(spark, sf, "orders")
    p = F.expr("""CASE WHEN o_totalprice < 100000 THEN '1-URGENT' WHEN o_totalprice < 200000 THEN '2-HIGH'
      WHEN o_totalprice < 300000 THEN '3-MEDIUM' WHEN o_totalprice < 400000 THEN '4-NOT SPECIFIED'
      ELSE '5-LOW' END""")
    return o.select("o_orderkey", F.col("o_orderpriority").alias("label"), p.alias("prediction"))


_PC_SQL = f"""(SELECT cls, tp, support, pred,
  CASE WHEN pred > 0 THEN tp / pred ELSE 0.0 END AS precision,
  CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM (
  SELECT cls, sum(tp) AS tp, sum(support) AS support, sum(pred) AS pred FROM (
    SELECT label AS cls, CASE WHEN label = prediction THEN 1 ELSE 0 END AS tp, 1 AS support, 0 AS pred FROM {_PRED_SQL}
    UNION ALL SELECT prediction, 0, 0, 1 FROM {_PRED_SQL}) GROUP BY cls))"""
_PCF_SQL = f"""(SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
  ELSE 0.0 END AS f1 FROM {_PC_SQL})"""


@register("classification_metrics", S, f"""
SELECT round(sum(tp) / sum(support), 6) AS accuracy,
  round(sum(precision * support) / sum(support), 6) AS precision_weighted,
  round(sum(recall * support) / sum(support), 6) AS recall_weighted,
  round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM {_PCF_SQL}""")
def q_classification_metrics(spark, sf):
    m = EV.classification_metrics(_pred(spark, sf))
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@register("macro_f1", S, f"SELECT round(avg(f1), 6) AS macro_f1 FROM {_PCF_SQL}")
def q_macro_f1(spark, sf):
    return EV.macro_f1(_pred(spark, sf)).select(F.round("macro_f1", 6).alias("macro_f1"))


@register("class_report", S, f"""
SELECT cls AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM {_PCF_SQL}
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  CAST(sum(support) AS BIGINT) FROM {_PCF_SQL}
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM {_PCF_SQL}""")
def q_class_report(spark, sf):
    r = EV.class_report(_pred(spark, sf))
    return r.select("class", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


_LABELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("confusion_matrix", S, "SELECT label, " + ", ".join(
    f"count(*) FILTER (WHERE prediction = '{v}') AS {EV._name(v)}" for v in _LABELS)
    + f" FROM {_PRED_SQL} GROUP BY label")
def q_confusion_matrix(spark, sf):
    return EV.confusion_matrix(_pred(spark, sf), _LABELS)


_REG_SQL = "(SELECT l_orderkey, l_linenumber, l_extendedprice AS label, l_quantity * 950.0::DOUBLE + 1000.0::DOUBLE AS prediction FROM lineitem)"


def _reg(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("label"),
                     (F.col("l_quantity") * 950.0 + 1000.0).alias("prediction"))


@register("regression_metrics", S, f"""
SELECT round(sqrt(avg((label - prediction) * (label - prediction))), 6) AS rmse,
  round(avg(abs(label - prediction)), 6) AS mae,
  round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 6) AS r2,
  count(*) AS n FROM {_REG_SQL}""")
def q_regression_metrics(spark, sf):
    m = EV.regression_metrics(_reg(spark, sf))
    return m.select(*[F.round(c, 6).alias(c) for c in ["rmse", "mae", "r2"]], "n")


@register("residual_table", S, f"""
SELECT l_orderkey, l_linenumber, label, prediction, label - prediction AS residual FROM {_REG_SQL}""")
def q_residual_table(spark, sf):
    rows, _rng = EV.residual_table(_reg(spark, sf).withColumn(
        "id", F.struct("l_orderkey", "l_linenumber")), "id")
    return rows.select("id.l_orderkey", "id.l_linenumber", "label", "prediction", "residual")


@register("residual_range", S, f"""
SELECT least(min(label), min(prediction)) AS lo, greatest(max(label), max(prediction)) AS hi FROM {_REG_SQL}""")
def q_residual_range(spark, sf):
    _rows, rng = EV.residual_table(_reg(spark, sf), "l_orderkey")
    return rng


_SCORE = "CAST(d.n_chars % 1000 AS DOUBLE) / 1000.0"
_BINSC_SQL = f"(SELECT d.doc_id, l.toxic AS label, {_SCORE} AS score FROM documents d JOIN labels l USING (doc_id))"


def _binsc(spark, sf):
    d = table(spark, sf, "documents").alias("d").join(table(spark, sf, "labels"), "doc_id")
    return d.select("doc_id", F.col("toxic").alias("label"), (F.expr("CAST(n_chars % 1000 AS DOUBLE)") / 1000.0)
                    .alias("score"))


_PR_SQL = f"""(SELECT threshold, tp, fp, tp / (tp + fp) AS precision, tp / (SELECT sum(label) FROM {_BINSC_SQL}) AS recall
FROM (SELECT threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM (
  SELECT score AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM {{src}} GROUP BY 1)
  WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)))"""


@register("pr_curve", S, "SELECT threshold, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall FROM "
          + _PR_SQL.format(src=_BINSC_SQL))
def q_pr_curve(spark, sf):
    c = EV.pr_curve(_binsc(spark, sf))
    return c.select("threshold", "tp", "fp", F.round("precision", 6).alias("precision"),
                    F.round("recall", 6).alias("recall"))


_F2 = "5 * precision * recall / (4 * precision + recall + 1e-10)"


@register("best_threshold", S, f"""
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(fscore, 6) AS fscore FROM (
  SELECT *, {_F2} AS fscore FROM {_PR_SQL.format(src=_BINSC_SQL)}) ORDER BY fscore DESC, threshold LIMIT 1""")
def q_best_threshold(spark, sf):
    b = EV.best_threshold(EV.pr_curve(_binsc(spark, sf)), 2.0)
    return b.select("threshold", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "fscore"]])


_BUCKET = "(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 100)"


@register("threshold_search", S, f"""
WITH b AS (SELECT *, {_BUCKET} AS bucket FROM {_BINSC_SQL}),
val AS (SELECT * FROM b WHERE bucket >= 60 AND bucket < 80),
curve AS {_PR_SQL.replace('{src}', 'val').replace(_BINSC_SQL, 'val')},
t AS (SELECT threshold FROM (SELECT *, {_F2} AS fscore FROM curve) ORDER BY fscore DESC, threshold LIMIT 1)
SELECT doc_id, CAST(score >= (SELECT threshold FROM t) AS INTEGER) AS prediction FROM b WHERE bucket >= 80""")
def q_threshold_search(spark, sf):
    from wellspark.plans.fixtures import bucket_expr
    d = _binsc(spark, sf).withColumn("bucket", F.expr(bucket_expr("doc_id")))
    val = d.where((F.col("bucket") >= 60) & (F.col("bucket") < 80))
    t = EV.best_threshold(EV.pr_curve(val), 2.0).first().threshold
    test = d.where(F.col("bucket") >= 80)
    return EV.apply_threshold(test, t).select("doc_id", "prediction")


@register("fbeta", S, f"""
WITH t AS (SELECT label, CAST(score >= 0.5 AS INTEGER) AS prediction FROM {_BINSC_SQL})
SELECT round(5.0 * count(*) FILTER (WHERE label = 1 AND prediction = 1) /
  (5.0 * count(*) FILTER (WHERE label = 1 AND prediction = 1) + 4 * count(*) FILTER (WHERE label = 1 AND prediction = 0)
   + count(*) FILTER (WHERE label = 0 AND prediction = 1)), 6) AS f2 FROM t""")
def q_fbeta(spark, sf):
    p = EV.apply_threshold(_binsc(spark, sf), 0.5)
    return EV.fbeta(p, 2.0).select(F.round("f2", 6).alias("f2"))


@register("udf_metric", S)
def q_udf_metric(spark, sf):
    p = EV.apply_threshold(_binsc(spark, sf), 0.5).withColumn("prediction", F.col("prediction").cast("double")) \
        .withColumn("label", F.col("label").cast("double"))
    f2 = EV.FBetaEvaluator(beta=2.0).evaluate(p)
    mf1 = EV.FBetaEvaluator(metric="macroF1").evaluate(p)
    return spark.createDataFrame([("f2", f2), ("macro_f1", mf1)], "metric string, value double")


@register("compare_models", S, f"""
WITH a AS (SELECT avg(f1) AS f FROM {_PCF_SQL}),
b AS (SELECT avg(f1) AS f FROM (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM {_PC_SQL.replace(_PRED_SQL, "(SELECT o_orderpriority AS label, '1-URGENT' AS prediction FROM orders)")}))
SELECT 'rule_by_price' AS experiment, round(a.f, 6) AS macro_f1, round((a.f - b.f) / b.f * 100, 4) AS gain_pct FROM a, b
UNION ALL SELECT 'constant_urgent', round(b.f, 6), 0.0 FROM b""")
def q_compare_models(spark, sf):
    from wellspark.operators.tune import compare_models
    base = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("label"),
                                             F.lit("1-URGENT").alias("prediction"))
    return compare_models({"rule_by_price": _pred(spark, sf), "constant_urgent": base}, "constant_urgent")


# -------------------------------------------------------------------- encoders

_Z_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
_LI_TRAIN = f"(SELECT * FROM lineitem WHERE {split_sql('l_orderkey')} = 'train')"


@register("zscore", S, "WITH p AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _Z_COLS) + f" FROM {_LI_TRAIN}) "
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _Z_COLS)
    + " FROM lineitem, p")
def q_zscore(spark, sf):
    li = table(spark, sf, "lineitem")
    z = EN.ZScore(_Z_COLS).fit(li.where(split_col("l_orderkey") == "train"))
    return z.transform(li).select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in _Z_COLS])


_ORD_TRAIN_WHERE = f"{split_sql('o_orderkey')} = 'train'"


def _onehot_sql(drop_first: bool) -> str:
    vals = _LABELS[1:] if drop_first else _LABELS
    return "SELECT o_orderkey, " + ", ".join(
        f"CAST(coalesce(o_orderpriority = '{v}', false) AS INTEGER) AS \"o_orderpriority_{v}\"" for v in vals) + \
        " FROM orders"


@register("one_hot_drop_first", S, _onehot_sql(True))
def q_one_hot_drop_first(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    cats = EN.fit_categories(o.where(split_col("o_orderkey") == "train"), ["o_orderpriority"])
    return EN.one_hot(o, cats, drop_first=True)


@register("one_hot_full", S, _onehot_sql(False))
def q_one_hot_full(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    cats = EN.fit_categories(o.where(split_col("o_orderkey") == "train"), ["o_orderpriority"])
    return EN.one_hot(o, cats, drop_first=False)


@register("label_encode", S, f"""
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS o_orderpriority_code FROM orders""")
def q_label_encode(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    enc = EN.LabelEncoder("o_orderpriority").fit(o.where(split_col("o_orderkey") == "train"))
    return enc.transform(o).select("o_orderkey", "o_orderpriority_code")


def _anova_sql(n_feat: int) -> str:
    cols = ", ".join(f"('f{i:02d}', v[{i + 1}])" for i in range(n_feat))
    return f"""
WITH long AS (SELECT label, u.feature, u.x FROM {_EMB_SQL} e,
  LATERAL (SELECT * FROM (VALUES {cols}) t(feature, x)) u),
g AS (SELECT feature, label, count(*) AS n, sum(x) AS s, sum(x * x) AS ss FROM long GROUP BY 1, 2),
t AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(s) AS s, sum(ss) AS ss, sum(s * s / n) AS br FROM g GROUP BY 1)
SELECT feature, round(((br - s * s / n) / (k - 1)) / ((ss - br) / (n - k)), 4) AS f_score FROM t"""


@register("select_k_best", S, _anova_sql(64))
def q_select_k_best(spark, sf):
    e = _emb(spark, sf)
    wide = e.select("label", *[F.col("vec")[i].alias(f"f{i:02d}") for i in range(64)])
    return EN.anova_f(wide, "label", [f"f{i:02d}" for i in range(64)]).select(
        "feature", F.round("f_score", 4).alias("f_score"))


@register("select_k_best_columns", S, f"""
WITH f AS ({_anova_sql(64).replace("round(", "(").replace(", 4) AS", ") AS")}),
best AS (SELECT feature FROM f ORDER BY f_score DESC, feature LIMIT 10)
SELECT e.vec_id, best.feature, e.v[CAST(substr(best.feature, 2) AS INTEGER) + 1] AS x FROM {_EMB_SQL} e, best""")
def q_select_k_best_columns(spark, sf):
    """The table cut to the 10 best columns, as (row, column name, value)."""
    names = [f"f{i:02d}" for i in range(64)]
    wide = _emb(spark, sf).select("vec_id", "label", *[F.col("vec")[i].alias(f) for i, f in enumerate(names)])
    best = EN.select_k_best(wide, "label", names, 10)
    return wide.select("vec_id", F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("x"))
                                                      for f in best])).alias("c")).select("vec_id", "c.*")
