"""Toxicity through a weighted finite-state pattern grammar.

A text is read as clauses of word classes: insult (I), threat verb (T), target
(Y), negation (N), reported speech (R), other word (o) and clause end (|).
A first transducer reads a clause from its end and writes the class string
anew: every insult and threat with marks for a target (y) and a verb of
reporting (r) behind it.  Five small transducers read what it wrote, from the
front, and write weights: insult and threat write the weight of a match, target
raises it, negation and reported speech lower it; targets and verbs of
reporting count on either side of the match.  The five are composed (states
reached together, product of weights) into one automaton that runs once over
every marked clause with an insult or a threat, so the matched clause is scored
and not the isolated word.  Sum, maximum and number of clause scores feed a
logistic curve.

The insult class is a lexicon of words and word beginnings learned from
labelled rows; the other classes are short fixed lists, threats with their
inflected forms by rule.

Defined results: a null or empty text, and one without matched clause, has the
curve's lowest score; columns other than the id and the text are ignored;
repeated rows give repeated results; without sampled labels of both classes no
text is toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.common import fit_logistic, labelled_sample, sigmoid

# Bounds of the learning sample and of the lexicon (parameters of ``fit``).
PER_CLASS, MAX_CHARS, LEXICON = 2500, 20_000, 20_000
# Word beginnings of these lengths may enter the lexicon.
STEMS = (3, 4, 5, 6)

# Closed-class words of the four languages.
TARGET = "you your yours u du dich dir euch ihr dein deine tu te toi vous ton votre tú ti usted ustedes vosotros".split()
NEGATION = "not no never isn't aren't don't nicht kein keine nie ne pas jamais aucun nunca ningún ninguna jamás".split()
REPORTED = ("said says say called calls quote quoted wrote sagte sagt sagen nannte schrieb dit disait appelle "
            "écrit dijo dice llamó escribió").split()
THREAT = ("kill hurt destroy beat stab shoot burn töten schlagen umbringen verletzen tuer frapper détruire "
          "matar golpear destruir herir").split()
# Forms of these verbs that no rule below gives.
IRREGULAR = ("beaten shot burnt schlägt schlägst schlug schlugen geschlagen umgebracht umbrachte "
             "verletzt détruit détruis détruisent hiere hieren hiero destruye destruyen destruyo").split()


def inflected(verb: str) -> set[str]:
    """The verb and its regular forms, by the ending that its language has."""
    out = {verb}
    if verb.endswith("en"):  # German
        stem = verb[:-2]
        link = "e" if stem[-1] in "td" else ""
        out |= {stem + e for e in ("e", link + "st", link + "t", link + "te", link + "ten")} | {f"ge{stem}{link}t"}
    elif verb.endswith("er"):  # French
        out |= {verb[:-2] + e for e in ("e", "es", "ons", "ez", "ent", "é", "ée", "és", "ais", "ait", "ant", "erai", "era")}
    elif verb.endswith(("ar", "ir")):  # Spanish
        vowel = verb[-2]
        out |= {verb[:-2] + e for e in (("o", "as", "a", "amos", "an", "é", "ó", "ado", "ando") if vowel == "a"
                                        else ("í", "ió", "imos", "ido", "iendo"))} | {verb + e for e in ("é", "á", "te")}
    elif not verb.endswith("re"):  # English
        short = len(verb) <= 4 and verb[-1] not in "wxy" and verb[-2] in "aeiou" and verb[-3] not in "aeiou"
        stem = verb + verb[-1] if short and verb[-1] != "l" else verb
        out |= {verb + "s", stem + "ed", stem + "ing"}
    return out


WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*|[.!?;:\n]")


@dataclass(frozen=True)
class Transducer:
    """Weighted transducer over word classes: ``step[state][class]`` is the next
    state (own state if absent), ``weight[state][class]`` what is written."""

    states: int
    step: dict[tuple[int, str], int]
    weight: dict[tuple[int, str], float]

    def next(self, s: int, c: str) -> int:
        return self.step.get((s, c), s)

    def out(self, s: int, c: str) -> float:
        return self.weight.get((s, c), 1.0)


MARKS = ("", "y", "r", "yr")
INSULTS, THREATS = tuple("I" + m for m in MARKS), tuple("T" + m for m in MARKS)
# What the marking transducer writes and the weighted ones read.
CLASSES = (*INSULTS, *THREATS, *"YNRo")


def mark(classes: list[str]) -> list[str]:
    """The sequential transducer that reads a clause from its end: its state is
    what it has seen (a target, a verb of reporting), its output the class of a
    match with that state."""
    out, state = [], ("", "")
    for c in reversed(classes):
        out.append(c + "".join(state) if c in "IT" else c)
        state = ("y" if c == "Y" else state[0], "r" if c == "R" else state[1])
    return out[::-1]


def grammar() -> tuple[Transducer, ...]:
    """target, negation, reported speech, insult, threat."""
    matches = INSULTS + THREATS
    # a target in the clause raises its matches
    target = Transducer(2, {(0, "Y"): 1}, {(s, c): 1.5 if c[0] == "I" else 2.0
                                           for s in (0, 1) for c in matches if s or "y" in c})
    # a negation reaches over the next three words
    negation = Transducer(4, {**{(s, c): s - 1 for s in (1, 2, 3) for c in CLASSES}, **{(s, "N"): 3 for s in range(4)}},
                          {(s, c): 0.4 for s in (1, 2, 3) for c in matches})
    # beside a verb of reporting the clause is somebody else's words
    reported = Transducer(2, {(0, "R"): 1}, {(s, c): 0.6 for s in (0, 1) for c in matches if s or "r" in c})
    # insults in a row weigh more than apart
    insult = Transducer(2, {**{(0, c): 1 for c in INSULTS}, (1, "o"): 0}, {(1, c): 1.25 for c in INSULTS})
    # a threat counts once its target stands in the clause
    threat = Transducer(2, {(0, "Y"): 1}, {(0, c): 0.1 for c in THREATS if "y" not in c})
    return target, negation, reported, insult, threat


def compose(parts: tuple[Transducer, ...]) -> Transducer:
    """One transducer for all: its states are the tuples of states that can be
    reached together (the start is number 0), its weights the products."""
    start = (0,) * len(parts)
    number, queue, step, weight = {start: 0}, [start], {}, {}
    for s in queue:
        for c in CLASSES:
            to = tuple(p.next(x, c) for p, x in zip(parts, s))
            if to not in number:
                number[to] = len(number)
                queue.append(to)
            step[number[s], c] = number[to]
            weight[number[s], c] = math.prod(p.out(x, c) for p, x in zip(parts, s))
    return Transducer(len(number), step, weight)


@dataclass
class Lexicon:
    words: dict[str, float]
    stems: dict[str, float]
    seen: dict[str, tuple[str, float]] = field(default_factory=dict)

    def classify(self, word: str) -> tuple[str, float]:
        """(class, weight) of a lower-cased word; kept in a bounded table."""
        got = self.seen.get(word)
        if got is None:
            w = self.words.get(word, 0.0)
            for n in STEMS:
                w = max(w, self.stems.get(word[:n], 0.0) if len(word) >= n else 0.0)
            got = ("I", w) if w > 0 else (FIXED.get(word, "o"), 1.0)
            if len(self.seen) >= 100_000:
                self.seen.clear()
            self.seen[word] = got
        return got


FIXED = {**dict.fromkeys(TARGET, "Y"), **dict.fromkeys(NEGATION, "N"), **dict.fromkeys(REPORTED, "R"),
         **{f: "T" for v in THREAT for f in inflected(v)}, **dict.fromkeys(IRREGULAR, "T")}


class Scorer:
    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.net = lexicon, compose(grammar())

    def clauses(self, text: str | None) -> list[float]:
        """Scores of the clauses in which an insult or a threat matched."""
        classify, seen = self.lexicon.classify, self.lexicon.seen
        out, clause, hit = [], [], False
        for tok in WORD.findall((text or "").lower()):
            c = seen.get(tok) or ((None, 0.0) if tok in ".!?;:\n" else classify(tok))
            if c[0] is None:
                if hit:
                    out.append(self.run(clause))
                clause, hit = [], False
                continue
            clause.append(c)
            if c[0] == "I" or c[0] == "T":
                hit = True
        if hit:
            out.append(self.run(clause))
        return out

    def run(self, clause: list[tuple[str, float]]) -> float:
        state = total = 0
        step, weight = self.net.step, self.net.weight
        for c, (_, w) in zip(mark([c for c, _ in clause]), clause):
            if c[0] in "IT":
                total += w * weight[state, c]
            state = step[state, c]
        return total

    def features(self, text: str | None) -> tuple[float, float, float]:
        found = self.clauses(text)
        if not found:
            return 0.0, 0.0, 0.0
        return math.log1p(sum(found)), math.log1p(max(found)), math.log1p(len(found))


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    stems: dict[str, float]
    beta: tuple[float, ...]


LETTERS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")


def _entries(word: str) -> list[str]:
    """``=word`` and the word's beginnings."""
    return ["=" + word, *(word[:n] for n in STEMS if len(word) >= n)]


def _entry_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        count = {0: Counter(), 1: Counter()}
        for text, y in zip(b["text"], b["y"]):
            count[y].update({e for w in set(LETTERS.findall(text.lower())) for e in _entries(w)})
        both = sorted({*count[0], *count[1]})
        yield pd.DataFrame({"e": both, "a": [count[1][e] for e in both], "b": [count[0][e] for e in both]})


def _entry_contexts(wanted: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = set()
            for text, y in zip(b["text"], b["y"]):
                words = LETTERS.findall(text.lower())
                found.update((e, n, y) for w, n in zip(words, [*words[1:], ""]) for e in _entries(w) if e in wanted)
            yield pd.DataFrame(sorted(found), columns=["e", "nxt", "y"]).astype({"y": "int32"})
    return run


def learn_lexicon(rows: DataFrame, size: int = LEXICON) -> tuple[dict[str, float], dict[str, float]]:
    """Words and word beginnings that stand almost only in toxic texts, counted
    by the distinct words that follow them; weight: log odds."""
    n = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos:
        return {}, {}
    # first by texts, which leaves few candidates; then those by contexts (the
    # following word), to which near copies of one text add nothing
    texts = (rows.mapInPandas(_entry_counts, "e string, a long, b long").groupBy("e")
             .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
             .where((F.col("a") >= 5) & (F.col("a") >= 10 * F.col("b"))).orderBy(F.desc("a"), "e").limit(size))
    wanted = frozenset(r["e"] for r in texts.collect())
    counts = (rows.mapInPandas(_entry_contexts(wanted), "e string, nxt string, y int").groupBy("e", "nxt")
              .agg(F.max("y").alias("a"), F.max(1 - F.col("y")).alias("b")).groupBy("e")
              .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
              .where((F.col("a") >= 5) & (F.col("a") >= 30 * F.col("b"))))
    whole, stems = {}, {}
    for r in counts.collect():
        odds = math.log((r["a"] + 0.5) / (pos + 1)) - math.log((r["b"] + 0.5) / (neg + 1))
        if odds <= 2:
            continue
        if r["e"].startswith("="):
            whole[r["e"][1:]] = odds
        else:
            stems[r["e"]] = odds
    return whole, stems


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", k: int = 5, r: int = 0,
        per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    """Lexicon from half of a bounded sample, the curve from the other half."""
    rows = labelled_sample(docs, labels, label, k, r, per_class, max_chars).persist()
    try:
        odd = F.col("h").bitwiseAND(F.lit(1)) == 1
        words, stems = learn_lexicon(rows.where(~odd))
        rest = rows.where(odd).toPandas().sort_values(["h", "id"])
    finally:
        rows.unpersist()
    scorer = Scorer(Lexicon(words, stems))
    if rest["y"].nunique() < 2:  # nothing says what is toxic
        return Model(words, stems, (0.0, 0.0, 0.0, -35.0))
    x = np.array([scorer.features(t) for t in rest["text"]]).reshape(-1, 3)
    return Model(words, stems, tuple(map(float, fit_logistic(x, rest["y"], rest["weight"], l2=1e-4))))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """id, ``score`` (0 to 1), ``predicted`` and ``n_clauses`` of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, beta = Scorer(Lexicon(model.words, model.stems)), np.array(model.beta)
        for b in batches:
            x = np.array([scorer.features(t) for t in b["text"]]).reshape(-1, 3)
            p = sigmoid(x @ beta[:-1] + beta[-1])
            yield pd.DataFrame({"id": b["id"].astype("Int64").values, "score": p, "predicted": (p >= threshold).astype("int32"),
                                "n_clauses": np.rint(np.expm1(x[:, 2])).astype("int64")})

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id long, score double, predicted int, n_clauses long").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all columns, whose score is below the threshold."""
    names = docs.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, beta = Scorer(Lexicon(model.words, model.stems)), np.array(model.beta)
        for b in batches:
            texts = b.iloc[:, names.index(text_col)]
            x = np.array([scorer.features(t) for t in texts]).reshape(-1, 3)
            yield b[sigmoid(x @ beta[:-1] + beta[-1]) < threshold]

    return docs.mapInPandas(run, docs.schema)
