"""Property and hand-table tests for operators without an exact SQL oracle,
and for the null / tie / unseen / skew rules of the survey (section 1.4)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wellspark.operators import clean, encode, neighbors, quantiles, textfeat, windows


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.columns == ["split", "rows_before", "rows_kept", "rows_removed", "pct_removed", "step"]
    rows = {r.split: r for r in df.collect()}
    assert set(rows) == {"train", "test"}
    for r in rows.values():
        assert r.rows_kept + r.rows_removed == r.rows_before


def test_exact_quantiles_match_numpy_on_skewed_data(spark):
    rng = np.random.default_rng(1)
    hot = np.full(3000, 7.0)  # a third of the rows share one value
    x = np.concatenate([hot, rng.normal(0, 1e6, 6000), [1e-300, -1e-300]])
    pdf = pd.DataFrame({"x": x, "g": np.where(np.arange(len(x)) % 3 == 0, "a", "b")})
    df = spark.createDataFrame(pdf)
    got = quantiles.quantiles(df, ["x"], [0.25, 0.5, 0.75], kind="disc")
    s = np.sort(x)
    for q in [0.25, 0.5, 0.75]:
        assert got[("", "x", q)] == s[math.ceil(q * len(s)) - 1]
    cont = quantiles.quantiles(df, ["x"], [0.3], kind="cont", group="g")
    for g, sub in pdf.groupby("g"):
        assert cont[(g, "x", 0.3)] == pytest.approx(np.quantile(sub.x, 0.3), rel=1e-12, abs=1e-9)


def _order_statistics(spark, monkeypatch, pdf, ranks, group=None):
    """Result, and the most rows that a pass read back for a target."""
    passes = []

    def counted(values, ranges, buckets, real=quantiles._narrowed):
        out = real(values, ranges, buckets)
        passes.append((out.count(), ranges.count()))
        return out

    monkeypatch.setattr(quantiles, "_narrowed", counted)
    got = quantiles.order_statistics(spark.createDataFrame(pdf), ["x"], ranks, group)[1]
    assert all(rows <= targets for rows, targets in passes) and len(passes) <= 12
    return got


def test_order_statistics_with_infinities_and_outliers(spark, monkeypatch):
    rng = np.random.default_rng(3)
    for odd in ([np.inf] * 3 + [-np.inf], [1.7e308, -1.7e308, 1e300], [5e-324, -5e-324, 0.0], []):
        x = np.concatenate([rng.normal(0, 1, 20_000), np.full(9000, 0.5), odd])
        ranks = [0, 3, len(x) // 4, len(x) // 2, 3 * len(x) // 4, len(x) - 3, len(x) - 1]
        got = _order_statistics(spark, monkeypatch, pd.DataFrame({"x": x}), lambda n: ranks)
        assert [got[("", "x", r)] for r in ranks] == np.sort(x)[ranks].tolist()


def test_order_statistics_over_many_magnitudes(spark, monkeypatch):
    x = np.concatenate([2.0 ** np.arange(-1000, 1000), -(3.0 ** np.arange(-600, 600))])
    ranks = list(range(5, len(x), 401))
    got = _order_statistics(spark, monkeypatch, pd.DataFrame({"x": x}), lambda n: ranks)
    assert [got[("", "x", r)] for r in ranks] == np.sort(x)[ranks].tolist()


def test_order_statistics_of_many_groups(spark, monkeypatch):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.integers(0, 50, 30_000) / 7.0, "g": rng.integers(0, 1500, 30_000).astype(str)})
    got = _order_statistics(spark, monkeypatch, pdf, lambda n: [n // 2], "g")
    for g, sub in pdf.groupby("g"):
        assert got[(g, "x", len(sub) // 2)] == np.sort(sub.x)[len(sub) // 2]


def test_iqr_null_fails_and_all_null_column_skipped(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, None), (100.0, None)],
                               "a double, b double")
    limits = clean.iqr_limits(df, 1.5)
    assert "b" not in limits  # all-null column is skipped
    kept = clean.iqr_filter(df, limits).collect()
    assert all(r.a is not None for r in kept)


def test_binary_mode_tie_goes_to_smaller_value(spark):
    df = spark.createDataFrame([(" Yes",), ("no",), ("yes ",), ("NO",), (None,)], "c string")
    r = clean.binary_mode(df, "c").first()
    assert (r.value, r.n, r.is_yes) == ("no", 2, False)
    assert clean.fit_binary_modes(df, ["c"]) == {"c": False}


def test_yes_no_other_text_becomes_mode(spark):
    df = spark.createDataFrame([("maybe",), (None,), ("YES",)], "c string")
    from wellspark.functions.columns import yes_no_bool
    out = [r.c for r in df.select(yes_no_bool(F.col("c"), True).alias("c")).collect()]
    assert out == [True, True, True]


def test_one_hot_unseen_and_null_give_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    cats = encode.fit_categories(train, ["k"])
    test = spark.createDataFrame([("b",), ("z",), (None,)], "k string")
    out = encode.one_hot(test, cats, drop_first=True).collect()
    assert [tuple(r) for r in out] == [(1, 0), (0, 0), (0, 0)]


def test_label_encode_unseen_raises(spark):
    train = spark.createDataFrame([("b",), ("a",)], "k string")
    enc = encode.LabelEncoder("k").fit(train)
    assert [r.k_code for r in enc.transform(train).collect()] == [1, 0]
    with pytest.raises(Exception):
        enc.transform(spark.createDataFrame([("zz",)], "k string")).collect()


def test_zscore_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "x double")
    z = encode.ZScore(["x"]).fit(df)
    vals = np.array([r.x for r in z.transform(df).collect()])
    assert vals.mean() == pytest.approx(0, abs=1e-12)
    assert vals.std(ddof=0) == pytest.approx(1, abs=1e-12)


def test_group_row_number_hot_group(spark):
    pdf = pd.DataFrame({"g": ["hot"] * 500 + ["x", "y"] * 50, "o": np.arange(600)[::-1]})
    df = spark.createDataFrame(pdf)
    got = windows.group_row_number(df, "g", ["o"], "rn", partitions=7).toPandas()
    want = pdf.assign(rn=pdf.groupby("g")["o"].rank(method="first").astype(int))
    m = got.merge(want, on=["g", "o"])
    assert len(m) == 600 and (m.rn_x == m.rn_y).all()


def test_cumulative_sums(spark):
    pdf = pd.DataFrame({"k": np.arange(200), "v": np.arange(200) % 7})
    got = windows.cumulative_sums(spark.createDataFrame(pdf), ["k"], ["v"], descending=True,
                                  partitions=5).toPandas().sort_values("k")
    want = pdf.sort_values("k", ascending=False).v.cumsum().sort_index()
    assert (got.cum_v.to_numpy() == want.to_numpy()).all()


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_knn_exact_vs_brute_force_with_split_hot_cell(spark, metric):
    rng = np.random.default_rng(3)
    hot = rng.normal(0, 0.01, size=(300, 8))  # a dense blob: one cell, many chunks
    rest = rng.normal(0, 5, size=(200, 8))
    x = np.vstack([hot, rest])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)],
                               "id long, vec array<double>")
    got = neighbors.knn(df, df, 4, metric=metric, exclude_self=True, n_pivots=6, chunk_rows=37,
                        block_rows=29).toPandas()
    d = (np.abs(x[:, None] - x[None]).sum(-1) if metric == "manhattan"
         else np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)))
    np.fill_diagonal(d, np.inf)
    for q in range(0, len(x), 17):
        want = np.lexsort((np.arange(len(x)), d[q]))[:4]
        have = got[got.qid == q].sort_values("rank").nid.to_numpy()
        assert list(have) == list(want)


def test_smote_points_lie_on_segments(spark):
    df = E.queries()["smote"](spark, SF_SMALL).toPandas()
    emb = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas().set_index("vec_id")
    counts = emb.label.eq(0).value_counts()
    assert len(df) == max(0, round(0.5 * counts.get(False, 0)) - counts.get(True, 0))
    for r in df.head(50).itertuples():
        a = np.asarray(emb.loc[r.src_id, "embedding"], float)
        b = np.asarray(emb.loc[r.nbr_id, "embedding"], float)
        assert np.allclose(np.asarray(r.vec), a + r.u * (b - a), atol=1e-9)


def test_stream_equals_batch(spark):
    Q = E.queries()
    stream = {r.event_id for r in Q["stream_clean"](spark, SF_SMALL).collect()}
    batch = {r.event_id for r in Q["iqr_filter"](spark, SF_SMALL).collect()}
    assert stream == batch
    scored = Q["stream_score"](spark, SF_SMALL).toPandas()
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert len(scored) == n and scored.event_id.is_unique


def test_model_reload_scores_identically(spark):
    assert all(r.same for r in E.queries()["sink_model"](spark, SF_SMALL).collect())


def test_udf_scalar_equals_native_chain(spark):
    Q = E.queries()
    a = Q["udf_scalar"](spark, SF_SMALL).toPandas().set_index("doc_id").text_clean
    b = Q["txt_clean_chain"](spark, SF_SMALL).toPandas().set_index("doc_id").text_clean
    assert (a.sort_index() == b.sort_index()).mean() > 0.99


def test_lemmas_use_lexicon(spark):
    df = spark.createDataFrame([(1, ["dogs", "dog", "boxes", "box", "glass"])], "id int, tokens array<string>")
    out = textfeat.lemmatize(df, "tokens").first().lemmas
    assert out == ["dog", "dog", "box", "box", "glass"]
    lexicon = spark.createDataFrame([("box",), (None,), ("glas",)], "word string")
    assert textfeat.lemmatize(df, "tokens", lexicon).first().lemmas == ["dogs", "dog", "box", "box", "glas"]


@pytest.mark.parametrize("most", [500_000, 0])  # looked up in the rows, and joined
def test_lemmas_of_repeated_ids_nulls_and_empty_tables(spark, monkeypatch, most):
    monkeypatch.setattr(textfeat, "LOOKUP_WORDS", most)
    rows = [(1, ["dogs", "run"]), (1, ["cats", "sit", None, "dog"]), (1, ["cats", "sit", None, "dog"]), (2, None), (3, []), (None, ["cat"])]
    df = spark.createDataFrame(rows, "id int, tokens array<string>")
    got = textfeat.lemmatize(df, "tokens").collect()
    want = [(1, ("dog", "run")), (1, ("cat", "sit", None, "dog")), (1, ("cat", "sit", None, "dog")), (2, ()), (3, ()), (None, ("cat",))]
    assert sorted(((r.id, tuple(r.lemmas)) for r in got), key=str) == sorted(want, key=str)
    assert textfeat.lemmatize(df.limit(0), "tokens").count() == 0


def test_lemmas_read_the_texts_twice(spark):
    """Once for the words, once to rewrite; nothing is joined to the rows."""
    df = spark.createDataFrame([(1, ["dogs", "dog"])], "id int, tokens array<string>")
    words = textfeat.lemma_table(df.select(F.explode("tokens").alias("word")))
    plan = words._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Generate explode(tokens") == 1
    assert "Join" not in textfeat.lemmatize(df, "tokens")._jdf.queryExecution().optimizedPlan().toString()


def test_kmeans_elbow_k1_closed_form(spark):
    from wellspark.operators import models
    e = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],), ([0.0, 2.0],)], "arr array<double>")
    assert models.total_sum_of_squares(e, "arr") == pytest.approx(16 / 3)


def test_models_learn_a_separable_fixture(spark):
    """The test tables carry no learnable signal (random labels and prices),
    so learnability is checked on a small hand-made fixture."""
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType
    from wellspark.operators import evaluate, models
    rows = [(Vectors.dense([float(i), float(i % 3)]), float(i >= 20), 2.0 * i) for i in range(40)]
    schema = StructType([StructField("features", VectorUDT()), StructField("label", DoubleType()),
                         StructField("y", DoubleType())])
    df = spark.createDataFrame(rows, schema)
    clf = models.fit_logreg(df, C=100.0, max_iter=500, balanced=True)
    acc = evaluate.classification_metrics(clf.transform(df)).first().accuracy
    assert acc >= 0.95
    reg = models.fit_gbt_regressor(df, label="y", max_iter=20, depth=3)
    r2 = evaluate.regression_metrics(reg.transform(df), "y", "prediction").first().r2
    assert r2 > 0.9


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "a double, k string")
    assert clean.iqr_limits(empty, 1.5) == {}
    rep = clean.retention_report({"train": empty}, clean.iqr_predicate({})).collect()
    assert rep == []
    assert clean.null_audit(empty).first().a is None
    cats = encode.fit_categories(empty, ["k"])
    assert cats == {"k": []}
    assert encode.one_hot(empty, cats).columns == ["a"]


@pytest.mark.parametrize("seed", [None, 42])
def test_first_rows_per_group_hot_group(spark, seed):
    import hashlib
    from wellspark.operators.split import first_rows_per_group
    pdf = pd.DataFrame({"id": np.arange(3000), "g": ["hot"] * 2000 + ["a", "b"] * 500})
    df = spark.createDataFrame(pdf)
    got = first_rows_per_group(df, "g", "id", lambda n: (n + 2) // 3, seed).toPandas()
    if seed is None:
        order = pdf.assign(o=pdf.id)
    else:
        order = pdf.assign(o=[hashlib.md5(f"{i}{seed}".encode()).hexdigest() for i in pdf.id])
    want = order.sort_values(["o", "id"]).groupby("g").apply(
        lambda x: x.head((len(x) + 2) // 3), include_groups=False).reset_index(level=0)
    assert sorted(got.id) == sorted(want.id)


def test_pca_output_is_centred_2d(spark):
    pdf = E.queries()["pca_2d"](spark, SF_SMALL).toPandas()
    m = np.vstack(pdf.pca.to_numpy())
    assert m.shape[1] == 2 and np.allclose(m.mean(axis=0), 0, atol=1e-6)


def test_word_vectors_and_neighbours(spark):
    Q = E.queries()
    vec = Q["word2vec"](spark, SF_SMALL).limit(5).toPandas()
    assert all(len(v) == 100 for v in vec.vector)
    sim = Q["similar_words"](spark, SF_SMALL).toPandas()
    assert (sim.groupby("target").size() <= 10).all()
    assert (sim.similarity <= 1 + 1e-9).all() and "not_in_vocabulary" not in set(sim.target)


def test_search_tables(spark):
    Q = E.queries()
    g = Q["grid_search"](spark, SF_SMALL).toPandas()
    assert len(g) == 6 and g.mean_metric.between(0, 1).all()
    r = Q["random_search"](spark, SF_SMALL).toPandas()
    assert len(r) == 10 and r.params.is_unique


def test_scoring_outputs(spark):
    Q = E.queries()
    sc = Q["score_class_mwb"](spark, SF_SMALL).toPandas()
    assert all(abs(sum(dict(p).values()) - 1) < 1e-3 for p in sc.probs)
    cl = Q["score_cluster"](spark, SF_SMALL).toPandas()
    assert all(len(d) == 5 for d in cl.distances) and cl.nombre.notna().all()
    assert all(min(d) == d[c] for d, c in zip(cl.distances, cl.cluster))


def test_rank_importance_sorted(spark):
    imp = E.queries()["rank_importance"](spark, SF_SMALL).toPandas()
    assert len(imp) <= 10 and (imp.importance > 0).all()
    assert list(imp.importance) == sorted(imp.importance, reverse=True)


def test_kde_curve_matches_numpy(spark):
    from wellspark.operators.profile import kde_curve
    x = np.random.default_rng(5).gamma(2.0, 3.0, 400)
    got = kde_curve(spark.createDataFrame(pd.DataFrame({"x": x})), "x", 50).toPandas().sort_values("point")
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 50)
    want = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose(got.density.to_numpy(), want, rtol=1e-9)


def test_knn_keeps_near_copies_and_cuts_ties(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 16))
    base /= np.linalg.norm(base, axis=1)[:, None]
    rows = np.vstack([base, base[0] + rng.normal(size=(40, 16)) * 1e-9, np.repeat(base[1:2], 300, axis=0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "id long, v array<double>")
    got = {}
    for r in neighbors.knn(df.where("id < 5"), df, 10, "id", "id", "v").collect():
        got.setdefault(r.qid, []).append((r["rank"], r.nid))
    for i in range(5):
        d = np.sqrt(((rows - rows[i]) ** 2).sum(1))
        assert [n for _, n in sorted(got[i])] == np.lexsort((np.arange(len(d)), d))[:10].tolist()


def test_normalize_leaves_a_zero_vector(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    assert sorted(r.u for r in df.select(neighbors.normalize("v").alias("u")).collect()) == [[0.0, 0.0], [0.6, 0.8]]


def test_metrics_of_constant_labels_and_missing_predictions(spark):
    from wellspark.operators import evaluate

    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0), (2.0, None)], "label double, prediction double")
    r = evaluate.regression_metrics(df).first()
    assert (r.rmse, r.mae, r.r2, r.n) == (1.0, 1.0, None, 2)
    none = spark.createDataFrame([(0, 0.2), (0, 0.7)], "label int, score double")
    assert {c.recall for c in evaluate.pr_curve(none).collect()} == {None}


def test_score_text_uses_bigrams_and_lemmas(spark, tmp_path):
    from wellspark.plans.q_models import q_score_text
    # both classes have the same words; only their order tells them apart
    texts = {"aa": "red dogs blue cat dog", "bb": "blue dogs red cat dog"}
    rows = [(i, texts[lang], lang) for i in range(60) for lang in (("aa", "bb")[i % 2],)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    got = q_score_text(spark, str(tmp_path)).collect()
    assert got and all(r.predicted == ("aa", "bb")[r.doc_id % 2] for r in got)
    assert {r.text_clean for r in got} == {"red dog blue cat dog", "blue dog red cat dog"}
