"""Term vectors and document frequencies of texts with and without repeated ids."""

import numpy as np
from pyspark.sql import functions as F

from wellspark.functions.text import word_tokens
from wellspark.operators import retrieve as RT


def test_rows_of_their_own_equal_grouped_postings(spark):
    rows = [(1, "aa bb aa"), (2, "cc"), (2, "cc dd"), (3, "!"), (None, "aa ee"), (None, "ee"), (4, "bb cc dd dd")]
    df = spark.createDataFrame(rows, "id long, t string")
    toks = word_tokens(F.col("t"))
    post = RT.postings(df, "id", toks)
    for some in (df, df.where("id IN (1, 3, 4)"), df.where("id = 2")):
        post = RT.postings(some, "id", toks)
        single, several = RT.parted_by_id(some, "id")
        got, want = ({r.id: (r.vec, r.dl) for r in d.collect()} for d in (
            RT.text_vectors(single, several, "id", toks, 8), RT.hashed_vectors(post, "id", 8)))
        assert got.keys() == want.keys() and all(np.array_equal(got[i][0], want[i][0]) and got[i][1] == want[i][1] for i in want)
        terms = spark.createDataFrame([("aa",), ("cc",), ("ee",)], "term string")
        freq = RT.document_frequency(single, several, "id", toks, terms)
        assert dict(freq.collect()) == dict(post.where("term IN ('aa', 'cc', 'ee')").groupBy("term").count().collect())


def test_terms_of_single_rows_are_not_shuffled(spark):
    df = spark.createDataFrame([(1, "aa bb"), (2, "cc")], "id long, t string")
    single, several = RT.parted_by_id(df, "id")
    plan = RT.text_vectors(single, several, "id", word_tokens(F.col("t")), 8)._jdf.queryExecution().executedPlan().toString()
    assert several is None and "Exchange" not in plan
