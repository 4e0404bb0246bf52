"""Characters taken out by one expression, against plain ones."""

from pyspark.sql import functions as F

from wellspark.functions import text as X


def test_punctuation_leaves_as_by_translate(spark):
    data = [(t,) for t in (None, "", X.PUNCTUATION, "a-b_c\\d]e[f^g~h", "\u0663x\uff11.5\u00b2 \u00bf\u2019", "it's 3.14!\t(ok)")]
    df = spark.createDataFrame(data, "t string")
    plain = F.translate("t", X.PUNCTUATION, "")
    got = df.select(plain.alias("a"), X.txt_strip_punct(F.col("t")).alias("b"),
                    F.translate(X.txt_strip_digits(F.col("t")), X.PUNCTUATION, "").alias("c"), X.txt_strip_digits_punct(F.col("t")).alias("d"))
    assert all(r.a == r.b and r.c == r.d for r in got.collect())
