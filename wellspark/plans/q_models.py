"""Registered queries: model fitting (2.13), search (2.14), scoring jobs
(2.16) and the MLlib-backed projections/encoders.  Model outputs differ from
the reference's libraries by construction, so these are rows-only checks;
``tests/`` holds their property tests."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import (MulticlassClassificationEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import functions as F

from wellspark.operators import evaluate as EV
from wellspark.operators import manykmeans as MK
from wellspark.operators import models as M
from wellspark.operators import requests as RQ
from wellspark.operators import tune as TU
from wellspark.operators.encode import assemble_vector
from wellspark.operators.split import stratified_folds
from wellspark.plans import fixtures as FX
from wellspark.plans.fixtures import split_col
from wellspark.plans.registry import register
from wellspark.session import text_batches
from wellspark.sources.tables import table

S = "models"


# ----------------------------------------------------------- feature frames

def emb_frame(spark, sf):
    """64-dim embeddings with a 10-class label."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", array_to_vector("embedding").alias("features"),
                    F.col("label").cast("double").alias("label"), split_col("vec_id").alias("split"))


_REG_COLS = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def reg_frame(spark, sf):
    li = table(spark, sf, "lineitem")
    f = li.select("l_orderkey", "l_linenumber", *[F.col(c).cast("double").alias(f"x_{c}") for c in _REG_COLS],
                  F.col("l_extendedprice").alias("label"), split_col("l_orderkey").alias("split"))
    return assemble_vector(f, [f"x_{c}" for c in _REG_COLS])


def status_frame(spark, sf):
    """orders: 3-class status from price and date parts."""
    o = table(spark, sf, "orders")
    f = o.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
                 F.year("o_orderdate").cast("double").alias("year"),
                 F.month("o_orderdate").cast("double").alias("month"), split_col("o_orderkey").alias("split"))
    f = StringIndexer(inputCol="o_orderstatus", outputCol="label", stringOrderType="alphabetAsc").fit(
        f.where("split = 'train'")).transform(f)
    return assemble_vector(f, ["o_totalprice", "year", "month"])


def toxic_frame(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    words = F.size(F.split(F.col("text"), r"\s+"))
    f = d.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), words.cast("double").alias("n_words"),
                 (F.col("lang") == "en").cast("double").alias("is_en"), F.col("quality").cast("double").alias("quality"),
                 F.col("toxic").cast("double").alias("label"), split_col("doc_id").alias("split"))
    return assemble_vector(f, ["n_chars", "n_words", "is_en", "quality"])


def _split(df):
    return df.where("split = 'train'"), df.where("split = 'test'")


def _cls_metrics(pred):
    m = EV.classification_metrics(pred, "label", "prediction")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


def _reg_metrics(pred):
    m = EV.regression_metrics(pred, "label", "prediction")
    return m.select(*[F.round(c, 6).alias(c) for c in ["rmse", "mae", "r2"]], "n")


# ------------------------------------------------------------------ fitting

@register("fit_logreg", S)
def q_fit_logreg(spark, sf):
    train, test = _split(emb_frame(spark, sf))
    model = M.fit_logreg(train, C=1.0, max_iter=5000, balanced=True)
    return _cls_metrics(model.transform(test))


@register("fit_gbt_regressor", S)
def q_fit_gbt_regressor(spark, sf):
    train, test = _split(reg_frame(spark, sf))
    model = M.fit_gbt_regressor(train, max_iter=20, step=0.1, depth=5)
    return _reg_metrics(model.transform(test))


@register("fit_gbt_classifier", S)
def q_fit_gbt_classifier(spark, sf):
    train, test = _split(status_frame(spark, sf))
    model = M.fit_gbt_classifier(train, n_classes=3, max_iter=50, step=0.1, depth=4)
    return _cls_metrics(model.transform(test))


@register("fit_gbt_imbalanced", S)
def q_fit_gbt_imbalanced(spark, sf):
    train, test = _split(toxic_frame(spark, sf))
    model = M.fit_gbt_imbalanced(train, pos_weight=100.0, subsample=0.8, colsample="0.8", max_iter=20, depth=4)
    pred = model.transform(test)
    return EV.fbeta(pred, 2.0, "label", "prediction", 1.0).select(F.round("f2", 6).alias("f2"))


@register("fit_random_forest", S)
def q_fit_random_forest(spark, sf):
    train, test = _split(emb_frame(spark, sf))
    model = M.fit_random_forest(train, trees=300, depth=12, min_split=5)
    return _cls_metrics(model.transform(test))


@register("fit_decision_tree", S)
def q_fit_decision_tree(spark, sf):
    train, test = _split(emb_frame(spark, sf))
    model = M.fit_decision_tree(train, depth=8)
    pred = model.transform(test)
    return _cls_metrics(pred)


@register("rank_importance", S)
def q_rank_importance(spark, sf):
    train, _test = _split(status_frame(spark, sf))
    model = M.fit_decision_tree(train, depth=8)
    imp = M.importances(model, ["o_totalprice", "year", "month"])
    df = spark.createDataFrame(imp, "feature string, importance double")
    return df.where("importance > 0").orderBy(F.desc("importance"), "feature").limit(10)


@register("fit_mlp_classifier", S)
def q_fit_mlp_classifier(spark, sf):
    train, test = _split(emb_frame(spark, sf))
    model = M.fit_mlp(train, [64, 41, 119, 65, 97, 65, 10], max_iter=100)
    return _cls_metrics(model.transform(test))


@register("fit_kmeans", S)
def q_fit_kmeans(spark, sf):
    e = emb_frame(spark, sf)
    model, inertia = MK.fit_best(e, k=5, starts=10, seed=46)
    sizes = model.transform(e).groupBy(F.col("prediction").alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("cost", F.lit(inertia))


@register("add_prediction_columns", S)
def q_add_prediction_columns(spark, sf):
    e = emb_frame(spark, sf)
    model, _ = MK.fit_best(e, k=5, starts=10, seed=46)
    return model.transform(e).select("vec_id", F.col("prediction").alias("cluster"), "label")


@register("kmeans_elbow", S)
def q_kmeans_elbow(spark, sf):
    return MK.elbow(table(spark, sf, "embeddings"), range(1, 50), starts=10, seed=46, features="embedding")


@register("fit_kernel_regression", S)
def q_fit_kernel_regression(spark, sf):
    f = M.dealt_for_features(reg_frame(spark, sf).drop("features"))
    inputs, waves = [f"x_{c}" for c in _REG_COLS], {"n_features": 100, "gamma": 0.01}
    f = M.rff_features(f, inputs, **waves)
    train, test = _split(f)
    model = M.fit_kernel_regression(train, inputs=inputs, **waves)
    return _reg_metrics(model.transform(test))


# ------------------------------------------------------------------- search

@register("grid_search", S)
def q_grid_search(spark, sf):
    e = emb_frame(spark, sf)
    train, _test = _split(e)
    train = stratified_folds(train, "vec_id", "label", 5, 46).withColumn("fold", F.col("fold"))
    lr = LogisticRegression(maxIter=50, family="multinomial")
    ev = MulticlassClassificationEvaluator(metricName="f1")
    _model, res = TU.grid_search(lr, {lr.regParam: [0.001, 0.01, 0.1], lr.elasticNetParam: [0.0, 0.5]},
                                 ev, train, fold_col="fold", parallelism=4)
    return res


@register("grid_search_balanced", S)
def q_grid_search_balanced(spark, sf):
    """Resampling ratio, features and tree depth of a toxic-document model in one grid, by F2."""
    from pyspark.ml.classification import DecisionTreeClassifier
    train, _test = _split(toxic_frame(spark, sf).withColumn("vec", vector_to_array("features")))
    tree = DecisionTreeClassifier(seed=46)
    fit = TU.BalancedFit(base=tree, id_col="doc_id")
    return TU.balanced_grid(train, fit, {tree.maxDepth: [2, 4]}, ratios=[0.5, 1.0], k_bests=[2, 4], folds=5)[1]


@register("cross_val_depth", S)
def q_cross_val_depth(spark, sf):
    from pyspark.ml.classification import DecisionTreeClassifier
    train, _test = _split(emb_frame(spark, sf))
    train = stratified_folds(train, "vec_id", "label", 5, 46)
    dt = DecisionTreeClassifier(seed=46)
    _m, res = TU.grid_search(dt, {dt.maxDepth: list(range(2, 10))}, EV.FBetaEvaluator(metric="macroF1"),
                             train, fold_col="fold", parallelism=4)
    return res


@register("random_search", S)
def q_random_search(spark, sf):
    train, _test = _split(emb_frame(spark, sf))
    lr = LogisticRegression(family="multinomial")
    space = {lr.regParam: lambda r: 10 ** r.uniform(-4, 0), lr.elasticNetParam: [0.0, 0.25, 0.5],
             lr.maxIter: [50, 100, 200]}
    _m, res = TU.random_search(lr, space, MulticlassClassificationEvaluator(metricName="f1"), train,
                               trials=10, seed=42, parallelism=4)
    return res


@register("split_validation", S)
def q_split_validation(spark, sf):
    train, _test = _split(reg_frame(spark, sf))
    lr = LinearRegression()
    space = {lr.regParam: [0.0, 0.1, 1.0]}
    _m, res = TU.random_search(lr, space, RegressionEvaluator(metricName="rmse"), train, trials=3,
                               train_ratio=0.8, seed=42)
    return res


# ------------------------------------------------------- MLlib projections

@register("assemble_vector", S)
def q_assemble_vector(spark, sf):
    f = reg_frame(spark, sf)
    return f.select("l_orderkey", "l_linenumber", vector_to_array("features").alias("features"))


@register("column_stages", S)
def q_column_stages(spark, sf):
    """Different transforms per column group chained with the model."""
    f = status_frame(spark, sf).drop("features")
    train, test = _split(f)
    pipe = Pipeline(stages=[
        StringIndexer(inputCol="o_orderpriority", outputCol="prio_idx", handleInvalid="keep"),
        OneHotEncoder(inputCol="prio_idx", outputCol="prio_vec", dropLast=False, handleInvalid="keep"),
        VectorAssembler(inputCols=["prio_vec", "o_totalprice", "year", "month"], outputCol="features"),
        LogisticRegression(maxIter=100, family="multinomial"),
    ])
    return _cls_metrics(pipe.fit(train).transform(test))


# ------------------------------------------------------------------ scoring

def _requests(raw, numbers, choices, keys, **targets):
    """Learned on the training part, applied to the raw rows of the other."""
    model = RQ.fit_requests(raw.where("split = 'train'"), numbers, choices, **targets)
    return RQ.score_requests(model, raw.where("split = 'test'"), keys)


@register("score_class_mwb", S)
def q_score_class_mwb(spark, sf):
    return _requests(FX.usage_requests(spark, sf), FX.USAGE_NUMBERS, FX.USAGE_CHOICES, ["l_orderkey", "l_linenumber"], class_col="level",
                     classifier=LogisticRegression(maxIter=5000, family="multinomial"))[0]


@register("score_value_mwb", S)
def q_score_value_mwb(spark, sf):
    return _requests(FX.usage_requests(spark, sf), FX.USAGE_NUMBERS, FX.USAGE_CHOICES, ["l_orderkey", "l_linenumber"], value_col="wellbeing",
                     regressor=GBTRegressor(maxIter=20, maxDepth=4, seed=42))[0]


def _health(spark, sf, level, score):
    return _requests(FX.health_requests(spark, sf), FX.HEALTH_NUMBERS, FX.HEALTH_CHOICES, ["o_orderkey"], class_col=level,
                     classifier=LogisticRegression(maxIter=200, family="multinomial"), value_col=score, regressor=LinearRegression(maxIter=100))


@register("score_gad7", S)
def q_score_gad7(spark, sf):
    return _health(spark, sf, "anxiety_level", "anxiety")[0]


@register("score_phq9", S)
def q_score_phq9(spark, sf):
    return _health(spark, sf, "depression_level", "depression")[0]


@register("score_rejects", S, f"""
SELECT o_orderkey, reason AS reject_reason FROM {FX.HEALTH_CHECKED_SQL} c WHERE split = 'test' AND reason <> ''""")
def q_score_rejects(spark, sf):
    """The reject table of the health requests: rows with the rules they fail."""
    raw = FX.health_requests(spark, sf).where("split = 'test'")
    checked = RQ.Check(numbers=FX.HEALTH_NUMBERS, choices=FX.HEALTH_CHOICES).transform(raw)
    return checked.where("reject_reason IS NOT NULL").select("o_orderkey", "reject_reason")


@register("score_encoded", S, f"""
WITH g AS (SELECT o_orderkey, split, TRY_CAST(trim(spent) AS DOUBLE) AS spent, TRY_CAST(trim(month) AS DOUBLE) AS month,
                  nullif(upper(trim(kind)), '') AS kind, upper(trim(status)) AS status FROM {FX.HEALTH_CHECKED_SQL} c WHERE reason = ''),
f AS (SELECT quantile_disc(spent, 0.5) AS spent FROM g WHERE split = 'train'),
k AS (SELECT kind FROM g WHERE split = 'train' AND kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1),
i AS (SELECT o_orderkey, split, coalesce(g.spent, f.spent) AS spent, month, coalesce(g.kind, k.kind) AS kind, status FROM g, f, k),
z AS (SELECT avg(spent) AS ms, stddev_pop(spent) AS ss, avg(month) AS mm, stddev_pop(month) AS sm FROM i WHERE split = 'train')
SELECT o_orderkey, round((spent - ms) / ss, 6) AS spent, round((month - mm) / sm, 6) AS month,
       (kind = '2-HIGH')::INT AS kind_high, (kind = '3-MEDIUM')::INT AS kind_medium, (kind = '4-NOT SPECIFIED')::INT AS kind_none,
       (kind = '5-LOW')::INT AS kind_low, (status = 'O')::INT AS status_o, (status = 'P')::INT AS status_p
FROM i, z WHERE split = 'test'""")
def q_score_encoded(spark, sf):
    """What the model sees of a health request: coerced, imputed, encoded,
    scaled and aligned columns, learned on the valid training rows."""
    raw = FX.health_requests(spark, sf)
    prep = RQ.fit_preparation(raw.where("split = 'train'"), FX.HEALTH_NUMBERS, FX.HEALTH_CHOICES)
    x = vector_to_array("features")
    names = ["kind_high", "kind_medium", "kind_none", "kind_low", "status_o", "status_p"]
    return prep.transform(raw.where("split = 'test'")).where("reject_reason IS NULL").select(
        "o_orderkey", F.round(x[0], 6).alias("spent"), F.round(x[1], 6).alias("month"),
        *[x[i].cast("int").alias(n) for i, n in enumerate(names, 2)])


@register("score_cluster", S)
def q_score_cluster(spark, sf):
    from wellspark.operators.score import score_clusters
    e = emb_frame(spark, sf)
    model, _ = MK.fit_best(e, k=5, starts=10, seed=46)
    return score_clusters(model, e, "vec_id")


@register("score_text", S)
@text_batches
def q_score_text(spark, sf):
    from pyspark.ml.feature import CountVectorizerModel
    from wellspark.functions.text import clean_tokens, ngrams, word_tokens
    from wellspark.operators.score import score_classes
    from wellspark.operators.textfeat import count_vectorize, lemmatize
    d = table(spark, sf, "documents").select("doc_id", "lang", split_col("doc_id").alias("split"),
                                             clean_tokens(F.col("text")).alias("tokens"))
    # lemmas by the TRAIN words, for both parts
    words = d.where("split = 'train'").select(F.explode("tokens").alias("word"))
    d = lemmatize(d, "tokens", words).select(
        "doc_id", "lang", "split", F.when(F.col("tokens").isNotNull(), F.array_join("lemmas", " ")).alias("text_clean"))
    d = d.withColumn("_tok", word_tokens(F.col("text_clean")))
    vec, vocab = count_vectorize(d.where("split = 'train' AND lang IS NOT NULL"), F.col("_tok"))
    idx = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(vec)
    model = LogisticRegression(maxIter=100, family="multinomial").fit(idx.transform(vec).select("features", "label"))
    # score the test rows with the TRAIN vocabulary
    terms = [r.term for r in vocab.orderBy("index").collect()]
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol="_grams", outputCol="features")
    test = cv.transform(d.where("split = 'test'").withColumn("_grams", F.concat("_tok", ngrams(F.col("_tok"), 2))))
    return score_classes(model, test, list(idx.labels), "doc_id", ["text_clean"])
