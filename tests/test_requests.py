"""Raw request rows: rules, preparation, saved models and streams."""

from __future__ import annotations

import uuid

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wellspark.operators import quantiles as QT
from wellspark.operators import requests as RQ
from wellspark.plans import fixtures as FX
from wellspark.session import scratch_path
from wellspark.streaming import jobs

ROW = "id long, age string, hours string, job string, label string, y double"


@pytest.fixture(scope="module")
def model(spark):
    raw = FX.health_requests(spark, SF_SMALL)
    return RQ.fit_requests(raw.where("split = 'train'"), FX.HEALTH_NUMBERS, FX.HEALTH_CHOICES, class_col="anxiety_level",
                           classifier=LogisticRegression(maxIter=20, family="multinomial"), value_col="anxiety",
                           regressor=LinearRegression(maxIter=20))


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_rules(spark):
    df = spark.createDataFrame([
        (1, "20", " 3.5 ", " student", "a", 1.0), (2, None, "1", "STUDENT", "a", 1.0), (3, "abc", "NaN", "x", "a", 1.0),
        (4, "17", "Infinity", "", "a", 1.0), (5, "", "", None, None, None), (6, "1e1", "-1", "worker", "a", 1.0)], ROW)
    check = RQ.Check(numbers={"age": [18, 99, True], "hours": [0, None, False]}, choices={"job": [["STUDENT", "WORKER"], False]})
    got = {r.id: r.reject_reason for r in check.transform(df).collect()}
    assert got == {1: None, 2: "age: missing", 3: "age: not a number, hours: not a number, job: unknown value",
                   4: "age: out of range, hours: not a number", 5: "age: missing", 6: "age: out of range, hours: out of range"}
    assert check.transform(df.limit(0)).count() == 0


def test_preparation_matches_a_hand_count(spark):
    data = [(i, a, h, j, "c", 1.0) for i, (a, h, j) in enumerate(
        [("1", "10", "b"), ("2", "10", "a "), ("3", "10", None), ("10", None, "B"), (None, "10", "c.d"), ("oops", "1", "a")])]
    df = spark.createDataFrame(data, ROW)
    prep = RQ.fit_preparation(df, {"age": [None, None, False], "hours": [None, None, False]}, {"job": [None, False]}, {"hours": 4.0})
    out = prep.transform(df).where("reject_reason IS NULL").select("id", vector_to_array("features").alias("x"))
    # the bad row teaches nothing: median of 1, 2, 3, 10 is 2; most frequent job is B
    age, hours = [1, 2, 3, 10, 2], [10, 10, 10, 4, 10]
    jobs_ = [(1, 0), (0, 0), (1, 0), (1, 0), (0, 1)]  # B, A, B, B, C.D with A as the base
    scale = lambda v: [(x - sum(v) / 5) / (sum((y - sum(v) / 5) ** 2 for y in v) / 5) ** 0.5 for x in v]
    want = [(a, h, *j) for a, h, j in zip(scale(age), scale(hours), jobs_)]
    got = [tuple(r.x) for r in out.orderBy("id").collect()]
    assert all(abs(x - y) < 1e-9 for g, w in zip(got, want) for x, y in zip(g, w)) and len(got) == len(want)
    # an unseen value and a column that is not there are zeros
    new = RQ.Align(cols=["nothing", "job_B"]).transform(RQ.EncodeModel(values={"job": ["A", "B"]}).transform(
        spark.createDataFrame([("Z",), (None,), ("B",)], "job string")))
    assert [tuple(r[0]) for r in new.select(vector_to_array("features")).collect()] == [(0.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_saved_model_scores_the_same(spark, model, tmp_path):
    raw = FX.health_requests(spark, SF_SMALL).where("split = 'test'")
    scored, rejected = RQ.score_requests(model, raw, ["o_orderkey"])
    model.write().overwrite().save(str(tmp_path / "m"))
    scored2, rejected2 = RQ.score_requests(PipelineModel.load(str(tmp_path / "m")), raw, ["o_orderkey"])
    key = lambda df: sorted((r.o_orderkey, r.predicted, tuple(sorted(r.probs.items())), r.score) for r in df.collect())
    assert key(scored) == key(scored2) and rows(rejected) == rows(rejected2)
    assert scored.count() + rejected.count() == raw.count() and rejected.count() > 0
    r = scored.first()
    assert set(r.probs) == {"MINIMAL", "MILD", "MODERATE", "SEVERE"} and abs(sum(r.probs.values()) - 1) < 1e-3 and r.predicted in r.probs


def test_stream_scores_as_the_batch(spark, model):
    base = scratch_path(spark, f"requests-{uuid.uuid4().hex}")
    raw = FX.health_requests(spark, SF_SMALL).where("split = 'test'")
    raw.repartition(3).write.parquet(f"{base}/in")
    jobs.stream_requests(jobs.file_stream(spark, f"{base}/in", raw.schema, max_files=1), model, ["o_orderkey"],
                         f"{base}/valid", f"{base}/rejected", f"{base}/ckpt")
    scored, rejected = RQ.score_requests(model, raw, ["o_orderkey"])
    assert rows(spark.read.parquet(f"{base}/valid").select("o_orderkey", "predicted", "score")) == rows(scored.select("o_orderkey", "predicted", "score"))
    assert rows(spark.read.parquet(f"{base}/rejected").select("o_orderkey", "reject_reason")) == rows(rejected)


def test_values_do_not_move_to_their_ranges(spark):
    """The passes of the exact quantiles: the range table is broadcast whatever
    the planner thinks of its size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        values = QT._long(spark.range(1000).select(F.col("id").cast("double").alias("x")), ["x"], None)
        t = dict(g="", column=0, key=None, rank=5, lo=0.0, hi=999.0, uneven=False)
        plan = QT._narrowed(values, spark.createDataFrame([QT._range(0, t)], QT._RANGES), 16)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning(column" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_raw_rows_are_coerced_once_for_all_that_is_learned(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        read.add(1)
        return x

    data = [(i, str(i % 7), str(i % 5) if i % 3 else None, "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(data, "id long, age string, hours string, job string").repartition(2)
    df = df.withColumn("age", counted("age"))
    prep = RQ.fit_preparation(df, {"age": [None, None, False], "hours": [None, None, False]}, {"job": [None, False]})
    # the rule, the cast and the filter may each evaluate it, but in one reading
    assert read.value <= 4 * len(data)
    values = next(s for s in prep.stages if isinstance(s, RQ.ImputeModel)).given("values")
    assert values["age"] == 3.0 and values["job"] == "A"
