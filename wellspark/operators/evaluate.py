"""Model evaluation as DataFrame aggregations.

Everything starts from a (label, prediction[, score]) table and reduces it
with one grouped aggregate to a per-class table of at most classes^2 rows;
metrics are computed from that table.  The precision-recall curve uses the
distributed running sum of ``windows.cumulative_sums`` instead of a window
over one partition.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.operators.windows import cumulative_sums


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Errors over the rows that have both numbers; r2 is null where the label
    is constant, all are null without such rows."""
    e = F.col(label) - F.col(prediction)
    spread = F.var_pop(F.when(e.isNotNull(), F.col(label))) * F.count(e)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                  (1 - F.try_divide(F.sum(e * e), spread)).alias("r2"), F.count(e).alias("n"))


def residual_table(df: DataFrame, id_col: str, label: str = "label", prediction: str = "prediction"):
    rows = df.select(id_col, label, prediction, (F.col(label) - F.col(prediction)).alias("residual"))
    rng = df.agg(F.least(F.min(label), F.min(prediction)).alias("lo"),
                 F.greatest(F.max(label), F.max(prediction)).alias("hi"))
    return rows, rng


def per_class(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """tp, support (actual count) and predicted count per class, for the
    union of actual and predicted classes."""
    pairs = df.groupBy(F.col(label).alias("a"), F.col(prediction).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("cls"), F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
                 F.col("n").alias("support"), F.lit(0).cast("bigint").alias("pred")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("pred")))).alias("s")).select("s.*")
    t = both.groupBy("cls").agg(F.sum("tp").alias("tp"), F.sum("support").alias("support"),
                                F.sum("pred").alias("pred"))
    prec = F.when(F.col("pred") > 0, F.col("tp") / F.col("pred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    return t.select("cls", "tp", "support", "pred", prec.alias("precision"), rec.alias("recall"), f1.alias("f1"))


def class_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per-class precision, recall, f1, support plus 'macro avg' and
    'weighted avg' rows (zero_division = 0)."""
    pc = per_class(df, label, prediction)
    rows = pc.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1", "support")
    avg = pc.agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("n"))
    extra = avg.select(F.explode(F.array(
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")))).alias("r")) \
        .select("r.*")
    return rows.unionByName(extra)


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    pc = per_class(df, label, prediction)
    return pc.agg((F.sum("tp") / F.sum("support")).alias("accuracy"),
                  (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("precision_weighted"),
                  (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("recall_weighted"),
                  (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1_weighted"))


def macro_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return per_class(df, label, prediction).agg(F.avg("f1").alias("macro_f1"))


def confusion_matrix(df: DataFrame, labels: list, label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Counts by actual (rows) and predicted (columns ``p_<label>``) over a
    fixed label list, empty cells 0."""
    piv = df.groupBy(label).pivot(prediction, labels).agg(F.count(F.lit(1))).na.fill(0)
    return piv.select(label, *[F.col(f"`{v}`").alias(_name(v)) for v in labels])


def _name(v) -> str:
    return "p_" + "".join(ch if ch.isalnum() else "_" for ch in str(v))


def fbeta(df: DataFrame, beta: float = 2.0, label: str = "label", prediction: str = "prediction",
          positive=1) -> DataFrame:
    tp = F.count_if((F.col(label) == positive) & (F.col(prediction) == positive))
    fp = F.count_if((F.col(label) != positive) & (F.col(prediction) == positive))
    fn = F.count_if((F.col(label) == positive) & (F.col(prediction) != positive))
    b2 = beta * beta
    num = (1 + b2) * tp
    den = (1 + b2) * tp + b2 * fn + fp
    return df.agg(F.when(den > 0, num / den).otherwise(0.0).alias(f"f{beta:g}"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Precision and recall when predicting positive for score >= threshold,
    at every distinct score; recall is null without positives."""
    by_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("bigint")).alias("pos"),
        F.sum((1 - F.col(label)).cast("bigint")).alias("neg"))
    cum = cumulative_sums(by_score, ["threshold"], ["pos", "neg"], descending=True)
    total_pos = df.agg(F.sum(F.col(label).cast("bigint"))).scalar()
    return cum.select("threshold", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
                      F.try_divide(F.col("cum_pos"), total_pos).alias("recall"))


def best_threshold(curve: DataFrame, beta: float = 2.0) -> DataFrame:
    """Row of the curve with the highest F-beta (lowest threshold on ties)."""
    b2 = beta * beta
    f = (1 + b2) * F.col("precision") * F.col("recall") / (b2 * F.col("precision") + F.col("recall") + 1e-10)
    c = curve.withColumn("fscore", f)
    best = c.agg(F.min_by(F.struct("threshold", "precision", "recall", "fscore"),
                          F.struct(-F.col("fscore"), F.col("threshold"))).alias("b"))
    return best.select("b.*")


def apply_threshold(df: DataFrame, threshold: float, score: str = "score", out: str = "prediction"):
    return df.withColumn(out, (F.col(score) >= F.lit(threshold)).cast("int"))


class FBetaEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """F-beta of one class, or macro F1 when ``metric='macroF1'``, computed
    by a DataFrame aggregation; usable in ``CrossValidator``."""

    beta = Param(Params._dummy(), "beta", "beta", typeConverter=TypeConverters.toFloat)
    metric = Param(Params._dummy(), "metric", "fbeta or macroF1", typeConverter=TypeConverters.toString)
    positive = Param(Params._dummy(), "positive", "positive label", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, labelCol="label", predictionCol="prediction", beta=2.0, metric="fbeta",
                 positive=1.0):
        super().__init__()
        self._setDefault(beta=2.0, metric="fbeta", positive=1.0)
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        lab, pred = self.getLabelCol(), self.getPredictionCol()
        if self.getOrDefault(self.metric) == "macroF1":
            return float(macro_f1(dataset, lab, pred).first()[0] or 0.0)
        return float(fbeta(dataset, self.getOrDefault(self.beta), lab, pred,
                           self.getOrDefault(self.positive)).first()[0] or 0.0)

    def isLargerBetter(self) -> bool:
        return True
