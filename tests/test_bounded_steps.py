"""Steps that hold a bounded part of the rows at a time give what whole ones give."""

from __future__ import annotations

import numpy as np
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from wellspark.operators import models as M
from wellspark.operators import neighbors as NB


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
def test_neighbours_by_small_pieces(spark, monkeypatch, metric):
    for name, value in (("ROUTED", 7), ("SENT", 5), ("TRIED", 60)):
        monkeypatch.setattr(NB, name, value)
    x = np.random.default_rng(4).normal(size=(90, 6))
    x[:20] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").coalesce(2)
    got = {}
    for r in NB.knn(df, df, 3, metric=metric, exclude_self=True, n_pivots=5, chunk_rows=20, block_rows=30).collect():
        got.setdefault(r.qid, {})[r["rank"]] = r.nid
    d = np.abs(x[:, None] - x[None]).sum(2) if metric == "manhattan" else np.linalg.norm(x[:, None] - x[None], axis=2)
    want = {i: [j for _, j in sorted((d[i, j], j) for j in range(90) if j != i)[:3]] for i in range(90)}
    assert {q: [n[r] for r in sorted(n)] for q, n in got.items()} == want


@pytest.mark.parametrize("name", ["udf_batch", "udf_scalar", "txt_lemmas"])
def test_texts_come_in_small_batches(spark, name):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "10000")
    try:
        entry.queries()[name](spark, SF_SMALL)
        assert int(spark.conf.get(key)) <= 1000
    finally:
        spark.conf.set(key, before)


def test_rows_are_dealt_before_they_get_features(spark):
    df = spark.range(1000).coalesce(1)
    dealt = M.dealt_for_features(df, rows=100)
    assert dealt.rdd.getNumPartitions() == 10 and sorted(r.id for r in dealt.collect()) == list(range(1000))
    assert M.dealt_for_features(df, rows=1000).rdd.getNumPartitions() == 1


def test_ngrams_of_all_lengths_are_counted_in_one_reading(spark, capsys):
    out = entry.queries()["top_ngrams"](spark, SF_SMALL)
    out.explain("formatted")
    plan = capsys.readouterr().out.split("(1)")[0]
    assert plan.count("Scan parquet") == 1 and plan.count("WindowGroupLimit") == 2
