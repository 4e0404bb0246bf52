"""Language identification by a bidirectional gated recurrent network on bytes.

The network reads a word's bytes, with a space on both sides, from the left and
from the right; both hidden states at a byte give the language probabilities of
that position.  A document's probabilities are the mean over all positions of
its whole text.  States start anew at every word (and every ``PIECE`` bytes of a
longer one), so the labels of a word's positions are the same wherever it
stands: each distinct word of a task is run once and kept in a bounded table.
Training is backpropagation through time in numpy, with Adam, on the driver, on
words of a bounded sample of labelled texts.

Defined results: ``und`` with score 0 for a null text and one without a letter;
without labelled rows every text is ``und``; repeated rows give repeated
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import fold, slices

# Bounds of the fit: languages learned (the most frequent), texts of each,
# words of a text, characters of a text that may be learned from.
LANGUAGES, PER_LANGUAGE, WORDS, MAX_CHARS = 200, 400, 60, 20_000
HIDDEN, STEPS, BATCH, RATE = 12, 500, 256, 0.02
PIECE = 32  # bytes read without starting anew
TABLE = 200_000  # words kept per task


@dataclass(frozen=True)
class Model:
    langs: tuple[str, ...]
    table: np.ndarray  # (2, 256, 3 hidden): input weights of each byte
    state: np.ndarray  # (2, hidden, 3 hidden): recurrent weights
    out: np.ndarray  # (2 hidden + 1, languages)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def forward(x: np.ndarray, table: np.ndarray, state: np.ndarray, keep: bool = False):
    """Hidden states of one direction over (words, bytes); with ``keep`` also
    what the way back needs."""
    h = state.shape[0]
    out = np.zeros((x.shape[1], x.shape[0], h), table.dtype)
    now = np.zeros((x.shape[0], h), table.dtype)
    past = []
    for t in range(x.shape[1]):
        a, b = table[x[:, t]], now @ state
        zr = sigmoid(a[:, :2 * h] + b[:, :2 * h])
        z, r = zr[:, :h], zr[:, h:]
        n = np.tanh(a[:, 2 * h:] + r * b[:, 2 * h:])
        new = n + z * (now - n)
        if keep:
            past.append((now, z, r, n, b[:, 2 * h:]))
        out[t] = now = new
    return out, past


def backward(x, grad, past, state, d_table, d_state) -> None:
    """Adds the gradients of one direction; ``grad`` is that of its states."""
    carry = np.zeros_like(grad[0])
    for t in range(len(past) - 1, -1, -1):
        before, z, r, n, bn = past[t]
        d = grad[t] + carry
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * bn * r * (1 - r)
        to_state = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(d_table, x[:, t], np.concatenate([dz, dr, dn], axis=1))
        d_state += before.T @ to_state
        carry = d * z + to_state @ state.T


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def framed(words: list[bytes], size: int) -> np.ndarray:
    """Words of equal size as rows of bytes, a space on both sides."""
    x = np.full((len(words), size + 2), 32, np.uint8)
    x[:, 1:-1] = np.frombuffer(b"".join(words), np.uint8).reshape(-1, size)
    return x


def train(words: list[bytes], label: np.ndarray, langs: tuple[str, ...], seed: int = 3) -> Model:
    """Fit on words with their text's language: cross-entropy at every position."""
    rng, h = np.random.default_rng(seed), HIDDEN
    p = [rng.normal(0, 0.3, (2, 256, 3 * h)), rng.normal(0, 0.3, (2, h, 3 * h)), rng.normal(0, 0.3, (2 * h + 1, len(langs)))]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    sizes = np.array([len(w) for w in words])
    of = {s: np.flatnonzero(sizes == s) for s in np.unique(sizes)}
    keys = list(of)
    share = np.array([len(of[s]) * s for s in keys], float)
    for step in range(1, STEPS + 1):
        size = keys[rng.choice(len(keys), p=share / share.sum())]
        pick = rng.choice(of[size], min(BATCH, len(of[size])), replace=False)
        x, y = framed([words[i] for i in pick], size), label[pick]
        g = [np.zeros_like(a) for a in p]
        ways = [(x, *forward(x, p[0][0], p[1][0], True)), (x[:, ::-1], *forward(x[:, ::-1], p[0][1], p[1][1], True))]
        both = np.concatenate([ways[0][1], ways[1][1][::-1], np.ones((x.shape[1], len(x), 1))], axis=2)
        d = softmax(both @ p[2])
        d[:, np.arange(len(x)), y] -= 1
        d /= x.shape[0] * x.shape[1]
        g[2] += np.tensordot(both, d, axes=((0, 1), (0, 1)))
        back = d @ p[2].T
        for way, part in ((0, back[:, :, :h]), (1, back[::-1, :, h:2 * h])):
            backward(ways[way][0], part, ways[way][2], p[1][way], g[0][way], g[1][way])
        rate = RATE * (1 - 0.9 * step / STEPS)
        for i in range(3):
            m[i] = 0.9 * m[i] + 0.1 * g[i]
            v[i] = 0.99 * v[i] + 0.01 * g[i] ** 2
            p[i] -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return Model(langs, *(a.astype(np.float32) for a in p))


def pieces(raw: bytes) -> list[bytes]:
    """Words of a text's bytes, longer ones in pieces."""
    words = raw.split()
    if words and max(map(len, words)) > PIECE:
        words = [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


class Labeller:
    """Position probabilities of words, summed over a word's bytes."""

    def __init__(self, model: Model):
        self.model, self.place = model, {}
        self.sums = np.zeros((TABLE, len(model.langs) + 1), np.float32)

    def run(self, words: list[bytes], out: np.ndarray) -> None:
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes):
            which = np.flatnonzero(sizes == size)
            for lo in range(0, len(which), 2048):
                some = which[lo:lo + 2048]
                x = framed([words[i] for i in some], size)
                left, _ = forward(x, self.model.table[0], self.model.state[0])
                right, _ = forward(x[:, ::-1], self.model.table[1], self.model.state[1])
                w = self.model.out
                k = w.shape[0] // 2
                p = softmax(left[1:-1] @ w[:k] + right[::-1][1:-1] @ w[k:2 * k] + w[-1])
                out[some, :-1] = p.sum(axis=0)
                out[some, -1] = size

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of each text (zeros for one without words)."""
        docs = [pieces(t) for t in texts]
        fresh = list({w for d in docs for w in d if w not in self.place})
        if len(self.place) + len(fresh) > TABLE:
            self.place.clear()
            fresh = list({w for d in docs for w in d})
        if len(fresh) > len(self.sums):
            self.sums = np.zeros((len(fresh), self.sums.shape[1]), np.float32)
        base = len(self.place)
        self.run(fresh, self.sums[base:base + len(fresh)])
        self.place.update(zip(fresh, range(base, base + len(fresh))))
        out = np.zeros((len(docs), len(self.model.langs)))
        for i, d in enumerate(docs):
            if d:
                total = self.sums[[self.place[w] for w in d]].sum(axis=0, dtype=float)
                out[i] = total[:-1] / total[-1]
        return out


def fit(docs: DataFrame, k: int = 3, r: int = 1, per_language: int = PER_LANGUAGE, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Learns from texts whose crc32 fold is not ``r``; about ``per_language``
    of each language by the hash of the id, ``WORDS`` spread words of each."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).where(
        F.col("id").isNotNull() & F.col("lang").isNotNull() & (fold("id", k) != r))
    count = {x["lang"]: x["n"] for x in rows.groupBy("lang").agg(F.count("*").alias("n"))
             .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect()}
    if not count:
        return None
    share = F.lit(0.0)
    for lang, n in count.items():
        share = F.when(F.col("lang") == lang, F.lit(per_language / n)).otherwise(share)
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    got = (rows.where(part < share).where(F.char_length("text").between(1, MAX_CHARS))
           .withColumn("part", part).limit(2 * per_language * len(count)).toPandas().sort_values(["part", "text"]))
    langs = tuple(sorted(set(got["lang"])))
    words, label = [], []
    for text, lang in zip(got["text"], got["lang"]):
        some = pieces(text.encode("utf-8", "replace"))
        some = some[::max(1, len(some) // WORDS)][:WORDS]
        words += some
        label += [langs.index(lang)] * len(some)
    return train(words, np.array(label), langs) if words else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``lang_pred`` and ``score`` (the mean probability) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(model) if model else None
        for b in batches:
            texts = [t if isinstance(t, str) else "" for t in b["text"]]
            for lo, hi in slices(map(len, texts), 2_000_000):
                some = texts[lo:hi]
                has = np.array([any(map(str.isalpha, t)) for t in some])
                if labeller:
                    p = labeller.documents([t.encode("utf-8", "replace") if h else b"" for t, h in zip(some, has)])
                    best = p.argmax(axis=1)
                    name = [model.langs[j] if h else "und" for j, h in zip(best, has)]
                    score = np.where(has, p[np.arange(len(p)), best], 0.0)
                else:
                    name, score = ["und"] * len(some), np.zeros(len(some))
                yield pd.DataFrame({"id": b["id"].iloc[lo:hi].astype("Int64").values, "lang_pred": name, "score": np.clip(score, 0, 1)})

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)
