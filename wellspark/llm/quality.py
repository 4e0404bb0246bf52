"""Compression classifier for text quality.

Two zstandard dictionaries are trained, one from texts labelled good and one
from texts labelled bad.  A text is cut into blocks that are compressed with
each dictionary; the difference of the two total sizes, over the text's size,
says which dictionary knows it better, and a logistic curve fitted on labelled
rows kept apart from the dictionaries turns it into a score.

Blocks keep the dictionary useful throughout a long text (a long stream soon
learns from itself); all blocks of the whole text count.

Defined results: a null or empty text has difference 0 and the score of that;
columns other than the id and the text are ignored; repeated rows give repeated
results; without labels of both classes every score is the intercept's.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import fit_logistic, labelled_sample, sigmoid

# Bounds of the learning sample (all documented parameters of ``fit``).
PER_CLASS, MAX_CHARS = 2500, 20_000
DICT_BYTES, BLOCK, LEVEL = 32_768, 512, 3
SCALE = 20.0  # brings the differences near 1 for the curve's fit


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    beta: tuple[float, ...]


class Sizer:
    """Compressed sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.one, self.two = (zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False,
            write_checksum=False, write_dict_id=False) if d else None for d in (good, bad))

    def features(self, text: str | None) -> tuple[float, float]:
        raw = (text or "").encode("utf-8", "replace")
        if not raw or self.one is None or self.two is None:
            return 0.0, 0.0
        a = b = 0
        for i in range(0, len(raw), BLOCK):
            part = raw[i:i + BLOCK]
            a += len(self.one.compress(part))
            b += len(self.two.compress(part))
        return (b - a) / len(raw), (b - a) / (a + b)


def train_dictionary(texts: list[str]) -> bytes:
    parts = [raw[i:i + 2048] for raw in (t.encode("utf-8", "replace") for t in texts) for i in range(0, len(raw), 2048)]
    if len(parts) < 16:
        return b""
    try:
        return zstandard.train_dictionary(DICT_BYTES, parts).as_bytes()
    except zstandard.ZstdError:  # too little text to train from: use the text itself
        return b"".join(parts)[-DICT_BYTES:]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", k: int = 4, r: int = 2,
        per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Dictionaries from half of a bounded sample, the curve from the other."""
    rows = labelled_sample(docs, labels, label, k, r, per_class, max_chars).toPandas().sort_values(["h", "id"])
    first = (rows["h"].to_numpy() & 1) == 0 if len(rows) else np.zeros(0, bool)
    made = rows[first]
    good, bad = (train_dictionary(made.loc[made["y"] == y, "text"].tolist()) for y in (1, 0))
    sizer, rest = Sizer(good, bad), rows[~first]
    x = [sizer.features(t) for t in rest["text"]]
    beta = fit_logistic(np.array(x).reshape(-1, 2) * SCALE, rest["y"], rest["weight"], l2=1e-4)
    return Model(good, bad, tuple(map(float, beta)))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.7) -> DataFrame:
    """id, ``score`` (0 to 1) and ``predicted`` (score >= threshold) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizer, beta = Sizer(model.good, model.bad), np.array(model.beta)
        for b in batches:
            x = np.array([sizer.features(t) for t in b["text"]]).reshape(-1, 2) * SCALE
            p = sigmoid(x @ beta[:-1] + beta[-1])
            yield pd.DataFrame({"id": b["id"].astype("Int64").values, "score": p, "predicted": (p >= threshold).astype("int32")})

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id long, score double, predicted int").withColumnRenamed("id", id_col)
