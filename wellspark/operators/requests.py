"""Scoring of raw request rows as one saved model.

A request is a row of texts.  The stages below check, coerce, impute, encode,
scale and align it, then the model scores it and its classes get their names
back.  All of them are Spark ML transformers with plain parameters, so a fitted
``PipelineModel`` holds the whole path, is saved and loaded as one object and
serves batches and streams alike.  Every stage is column expressions.

A row that fails a rule gets its reasons in ``reject_reason``; ``score_requests``
parts these rows from the others, which alone reach the model.
"""

from __future__ import annotations

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import std_text
from wellspark.operators.alike import fit_classes, fit_least_squares
from wellspark.operators.quantiles import quantiles

REASON = "reject_reason"


class _Stage(Params, DefaultParamsReadable, DefaultParamsWritable):
    """Parameters by name; a value is anything that JSON can hold."""

    def _give(self, **values):
        for name, value in values.items():
            if value is not None:
                self._set(**{name: value})

    def given(self, name: str):
        return self.getOrDefault(self.getParam(name))


def _param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.identity)


class Check(_Stage, Transformer):
    """Adds ``reject_reason`` (names of the failed rules, null for a good row).

    ``numbers``: {column: [low, high, required]}; a text that is no number, or
    one outside [low, high] (null for no bound), fails, as does a missing value
    of a required column.  ``choices``: {column: [values, required]} compared
    after trimming and upper-casing; ``values`` null accepts any text."""

    numbers = _param("numbers", "bounds of the numeric columns")
    choices = _param("choices", "allowed values of the text columns")

    @keyword_only
    def __init__(self, *, numbers=None, choices=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        reasons = []
        for c, (low, high, required) in self.given("numbers").items():
            text, x = F.trim(F.col(c).cast("string")), _number(c)
            missing = F.coalesce(text == "", F.lit(True))
            reasons.append(F.when(missing, F.lit(f"{c}: missing") if required else None).when(
                x.isNull(), F.lit(f"{c}: not a number")).when(
                (x < low if low is not None else F.lit(False)) | (x > high if high is not None else F.lit(False)), F.lit(f"{c}: out of range")))
        for c, (values, required) in self.given("choices").items():
            v = std_text(F.col(c).cast("string"))
            missing = F.coalesce(v == "", F.lit(True))
            reasons.append(F.when(missing, F.lit(f"{c}: missing") if required else None).when(
                ~v.isin(values) if values is not None else F.lit(False), F.lit(f"{c}: unknown value")))
        text = F.concat_ws(", ", *reasons)
        return df.withColumn(REASON, F.when(text != "", text))


def _number(c: str) -> Column:
    """The column as a finite number, or null."""
    x = F.col(c).cast("string").try_cast("double")
    return F.when(F.abs(x) < float("inf"), x)


class Coerce(_Stage, Transformer):
    """Numeric columns as doubles (null where that fails), text columns trimmed
    and upper-cased (null where empty)."""

    numbers = _param("numbers", "numeric columns")
    texts = _param("texts", "text columns")

    @keyword_only
    def __init__(self, *, numbers=None, texts=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        out = {c: _number(c) for c in self.given("numbers")}
        out |= {c: F.nullif(std_text(F.col(c).cast("string")), F.lit("")) for c in self.given("texts")}
        return df.withColumns(out)


class Impute(_Stage, Estimator):
    """Learns what stands in for a missing value: the exact median of each of
    ``medians``, the most frequent value of ``modes`` (ties: the smallest), the
    given value of ``constants``.  A column without any value gets 0 or ``UNKNOWN``."""

    medians = _param("medians", "numeric columns")
    modes = _param("modes", "columns")
    constants = _param("constants", "value by column")

    @keyword_only
    def __init__(self, *, medians=None, modes=None, constants=None):
        super().__init__()
        self._setDefault(medians=[], modes=[], constants={})
        self._give(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ImputeModel":
        values = dict(self.given("constants"))
        medians = self.given("medians")
        found = quantiles(df, medians, [0.5]) if medians else {}
        for c in medians:
            values[c] = found.get(("", c, 0.5), 0.0)
        for c in self.given("modes"):
            top = (df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
                   .orderBy(F.desc("n"), c).first())
            values[c] = top[c] if top else ("UNKNOWN" if df.schema[c].dataType.simpleString() == "string" else 0.0)
        return ImputeModel(values=values)


class ImputeModel(_Stage, Transformer):
    """Fills missing values with the learned ones."""

    values = _param("values", "value by column")

    @keyword_only
    def __init__(self, *, values=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.given("values").items()})


class Encode(_Stage, Estimator):
    """Learns the sorted values of each text column; the first is the base."""

    cols = _param("cols", "text columns")

    @keyword_only
    def __init__(self, *, cols=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "EncodeModel":
        return EncodeModel(values={c: categories(df, c) for c in self.given("cols")})


MOST_VALUES = 1_000  # of a text column; one with more is no category


def categories(df: DataFrame, c: str) -> list[str]:
    rows = df.where(F.col(c).isNotNull()).select(c).distinct().limit(MOST_VALUES + 1).collect()
    if len(rows) > MOST_VALUES:
        raise ValueError(f"{c} has more than {MOST_VALUES} values")
    return sorted(r[0] for r in rows)


class EncodeModel(_Stage, Transformer):
    """0/1 columns ``column_VALUE`` for all values but the first; an unseen or
    missing value has zeros only."""

    values = _param("values", "sorted values by column")

    @keyword_only
    def __init__(self, *, values=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({f"{c}_{v}": F.coalesce(F.col(c) == v, F.lit(False)).cast("double")
                               for c, vs in self.given("values").items() for v in vs[1:]})


class Scale(_Stage, Estimator):
    """Learns mean and population deviation."""

    cols = _param("cols", "numeric columns")

    @keyword_only
    def __init__(self, *, cols=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ScaleModel":
        cols = self.given("cols")
        row = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return ScaleModel(centres={c: row[f"m{i}"] or 0.0 for i, c in enumerate(cols)},
                          scales={c: row[f"s{i}"] or 1.0 for i, c in enumerate(cols)})


class ScaleModel(_Stage, Transformer):
    """(x - mean) / deviation; a constant column is only centred."""

    centres = _param("centres", "mean by column")
    scales = _param("scales", "deviation by column")

    @keyword_only
    def __init__(self, *, centres=None, scales=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        scales = self.given("scales")
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(scales[c]) for c, m in self.given("centres").items()})


class Align(_Stage, Transformer):
    """``features``: the model's columns, all of them, in their order.  One that
    is not there, or has no value, is 0."""

    cols = _param("cols", "columns in order")

    @keyword_only
    def __init__(self, *, cols=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        there = set(df.columns)
        return df.withColumn("features", array_to_vector(F.array(*[
            F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) if c in there else F.lit(0.0) for c in self.given("cols")])))


class NameClasses(_Stage, Transformer):
    """``predicted`` (class name) and ``probs`` (name -> probability, 4 digits)
    from a model's prediction and probability columns."""

    labels = _param("labels", "class names in order")

    @keyword_only
    def __init__(self, *, labels=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = F.array(*[F.lit(x) for x in self.given("labels")])
        return df.withColumns({
            "predicted": F.element_at(names, F.col("prediction").cast("int") + 1),
            "probs": F.map_from_arrays(names, F.transform(vector_to_array("probability"), lambda p: F.round(p, 4)))})


class Label(_Stage, Transformer):
    """``label``: the place of the class name among ``labels``."""

    labels = _param("labels", "class names in order")
    col = _param("col", "column of the class name")

    @keyword_only
    def __init__(self, *, labels=None, col=None):
        super().__init__()
        self._give(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = F.array(*[F.lit(x) for x in self.given("labels")])
        return df.withColumn("label", (F.array_position(names, F.col(self.given("col"))) - 1).cast("double"))


def fit_preparation(train: DataFrame, numbers: dict, choices: dict, constants: dict | None = None) -> PipelineModel:
    """Check, coerce, impute, encode, scale and align, learned on the valid rows
    of ``train``."""
    constants = constants or {}
    nums, texts = list(numbers), list(choices)
    check, coerce = Check(numbers=numbers, choices=choices), Coerce(numbers=nums, texts=texts)
    # checked and coerced once: every median, mode, value list and scale reads the rows
    kept = coerce.transform(check.transform(train).where(F.col(REASON).isNull())) \
        .select(*dict.fromkeys([*nums, *texts, *constants])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        impute = Impute(medians=[c for c in nums if c not in constants], modes=[c for c in texts if c not in constants],
                        constants=constants).fit(kept)
        good = impute.transform(kept)
        encode, scale = Encode(cols=texts).fit(good), Scale(cols=nums).fit(good)
    finally:
        kept.unpersist()
    cols = nums + [f"{c}_{v}" for c, vs in encode.given("values").items() for v in vs[1:]]
    return PipelineModel([check, coerce, impute, encode, scale, Align(cols=cols)])


def fit_requests(train: DataFrame, numbers: dict, choices: dict, class_col: str | None = None, classifier=None,
                 value_col: str | None = None, regressor=None, constants: dict | None = None) -> PipelineModel:
    """One ``PipelineModel`` from raw rows to class names, probabilities and a
    value.  Learned on the valid rows that have a class and a value."""
    prep = fit_preparation(train, numbers, choices, constants)
    known = [c for c in (class_col, value_col) if c]
    ready = (prep.transform(train).where(F.col(REASON).isNull()).select("features", *known)
             .where(" AND ".join(f"`{c}` IS NOT NULL" for c in known)).persist())
    stages = list(prep.stages)
    try:
        if class_col:
            labels = categories(ready, class_col)
            classes = Label(labels=labels, col=class_col).transform(ready)
            fit = fit_classes if isinstance(classifier, LogisticRegression) and not classifier.isSet("weightCol") else _plain
            stages += [fit(classifier, classes), NameClasses(labels=labels)]
        if value_col:
            own = regressor.copy({regressor.labelCol: value_col, regressor.predictionCol: "value"})
            fit = fit_least_squares if isinstance(own, GBTRegressor) and own.getLossType() == "squared" \
                and not own.isSet("weightCol") else _plain
            stages.append(fit(own, ready))
    finally:
        ready.unpersist()
    return PipelineModel(stages)


def _plain(estimator, train: DataFrame):
    return estimator.fit(train)


def score_requests(model: PipelineModel, raw: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(scored, rejected): valid rows with what the model gives, and the others
    with their reasons.  The reject table does not run the model."""
    check = next(s for s in model.stages if isinstance(s, Check))
    checked = check.transform(raw)
    rejected = checked.where(F.col(REASON).isNotNull()).select(*keys, REASON)
    out = model.transform(checked.where(F.col(REASON).isNull()).drop(REASON))
    given = [c for c in ("predicted", "probs", "value") if c in out.columns]
    return out.select(*keys, *[F.round(c, 2).alias("score") if c == "value" else F.col(c) for c in given]), rejected
