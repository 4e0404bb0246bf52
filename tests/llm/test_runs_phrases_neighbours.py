"""Periodic runs, phrase collocations and nearest neighbours against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from wellspark.llm import collocations, hnsw, runs
from wellspark.llm.queries import QUERIES

EMPTY = hashlib.sha256(b"").hexdigest()


# ----------------------------------------------------------------- runs (11)

def brute_runs(w, least=24, exponent=3):
    n, best = len(w), {}
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, exponent * p):
                best.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n_, p) for (s, n_), p in best.items()), key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found, gone = brute_runs(w), set()
    for s, n_, q in found:
        gone.update(range(s + q, s + n_))
    top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    return (len(found), *top, None if top[0] is None else 1000 * top[1] // top[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def test_runs_of_random_sequences():
    rng = random.Random(5)
    for _ in range(150):
        docs = []
        for _ in range(rng.randint(1, 6)):
            k, w = rng.choice([1, 2, 3, 5, 50]), []
            while len(w) < rng.randint(0, 200):
                w += [rng.randrange(k) for _ in range(rng.randint(1, 12))] * rng.choice([1, 1, 2, 5, 9])
            docs.append(np.array(w, np.int64))
        for d, found in zip(docs, runs.runs_of(docs, 24, 3)):
            assert [tuple(map(int, r)) for r in found] == brute_runs(d.tolist())


def test_grammar_extensions_are_exact():
    rng = np.random.default_rng(2)
    words = np.concatenate([rng.integers(0, 3, 300), np.tile(rng.integers(0, 3, 17), 20), np.zeros(90, int)])
    seq = np.r_[7, words, 8].astype(np.int64)
    x = rng.integers(1, len(words), 400)
    y = rng.integers(1, len(words), 400)
    x, y = np.minimum(x, y), np.maximum(x, y)
    x, y = x[x < y], y[x < y]
    levels = runs.grammar(seq)
    ahead = runs.agree(levels, x, y)
    behind = runs.agree([lv.mirrored() for lv in levels], len(seq) - y, len(seq) - x)
    for i, j, f, b in zip(x, y, ahead, behind):
        assert (seq[i:i + f] == seq[j:j + f]).all() and seq[i + f] != seq[j + f]
        assert (seq[i - b:i] == seq[j - b:j]).all() and seq[i - b - 1] != seq[j - b - 1]


def test_op11_equals_brute_force_on_the_table(spark):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_runs"](spark, SF_SMALL).collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: brute_digest(r.doc_id, r.text) for r in rows}
    assert any(g[0] for g in got.values())


def test_runs_edges(spark):
    rng = random.Random(1)
    long = " ".join(rng.choice("abc") for _ in range(30000))
    texts = [(1, None), (2, ""), (3, " \t\n"), (4, "x " * 40), (4, "x " * 40), (None, "a b " * 30), (6, "é\u0085  z\n" * 13),
             (7, long), (8, long + " " + "p q r s t " * 9), (9, "A a " * 12)]
    df = spark.createDataFrame([(i, t, "r", 1, None) for i, t in texts],
                               "doc_id long, text string, runs string, id int, collapsed string")  # clashing extra columns
    found = runs.find_runs(df).collect()
    assert len(found) == len(texts)
    by = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in found}
    assert by[(1, "")] == by[(2, "")] == by[(3, "")] == []
    assert by[(4, "x")] == [(0, 40, 1)] and by[(None, "a b")] == [(0, 60, 2)] and by[(9, "A a")] == [(0, 24, 2)]
    assert by[(6, "é\u0085  z")] == [(0, 26, 2)]
    last = next(r for r in found if r.doc_id == 8)
    assert (30000, 45, 5) in [tuple(x) for x in last.runs] and last.collapsed.endswith("p q r s t")
    assert runs.digest(runs.find_runs(df.limit(0))).count() == 0
    d = {r.doc_id: r for r in runs.digest(runs.find_runs(df.where("doc_id < 3"))).collect()}
    assert d[1].n_runs == 0 and d[1].period is None and d[1].runs_sha256 == d[1].collapsed_sha256 == EMPTY


# --------------------------------------------------------- collocations (12)

def brute_phrases(rows, least, longest, top):
    total, f = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = {(lang, p[i:i + m]) for (lang, p), a in cand.items() for m in range(2, len(p)) for i in range(len(p) - m + 1)
              if a >= f[lang, p[i:i + m]]}
    out = []
    for lang in sorted(total):
        scored = []
        for (own, p), a in cand.items():
            if own == lang and (lang, p) not in inside:
                s, k = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
                scored.append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, x, y) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, x, y, total[lang], -s))
    return out


@pytest.mark.parametrize("shard, top", [(200_000, 2000), (40, 15)])
def test_collocations_equal_brute_force(spark, monkeypatch, shard, top):
    monkeypatch.setattr(collocations, "SHARD", shard)  # also with many tries
    monkeypatch.setattr(collocations, "ROW_WORDS", 50)
    rng = random.Random(3)
    vocab = ["the", "The", "of", "a-b", "été", "x", " ", "zz\u0085", "퟿", "\U0001f600"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(120):
        words = [rng.choice(vocab[:rng.choice([4, 40])]) + rng.choice(["", "", "", ".", ", ", "\n", "!"]) for _ in range(rng.randint(0, 150))]
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), rng.choice([" ", "\t", "  "]).join(words)))
    rows += [("en", "new york city hall opens " * 60), ("en", None), ("de", ""), ("de", "...!"), ("fr", "a a a a a a " * 40)]
    df = spark.createDataFrame([(1, t, lang, "h", 2) for lang, t in rows], "doc_id long, text string, lang string, word string, n int")
    got = [tuple(r) for r in collocations.collocations(df, least=12, longest=5, top=top).orderBy("lang", "rank").collect()]
    want = brute_phrases(rows, 12, 5, top)
    assert got == want and len(got) > 20
    assert collocations.collocations(df.limit(0)).count() == 0 and collocations.collocations(df.limit(3), least=5000).count() == 0


def test_quotient_is_exact_past_64_bits(spark):
    from pyspark.sql import functions as F
    rows = [(10 ** 9 + 7, 10 ** 14 + 9, 10 ** 9 + 9, 10 ** 9 + 11), (3 * 10 ** 12, 9 * 10 ** 15, 3 * 10 ** 12 + 1, 3 * 10 ** 12), (100, 100, 100, 100)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = [r[0] for r in df.select(collocations.quotient(*[F.col(c) for c in "anlr"])).collect()]
    assert got == [1000 * a * n // (x * y) for a, n, x, y in rows]


def test_a_shared_number_starts_over(spark, monkeypatch):
    """Numbers that do not tell words apart are dropped for others."""
    real, tried = collocations.series, []

    def weak(seed, n):
        tried.append(seed)
        table = real(seed, n).copy()
        if seed == 101:
            table[:] = table[0]  # words of one length share a number
        return table

    rows = [("en", "aa bb cc. " * 30 + "bb aa. " * 10)]
    seq, words, u, _ = collocations.numbered([rows[0][1]], 101)
    monkeypatch.setattr(collocations, "series", weak)
    same = collocations.numbered([rows[0][1]], 101)
    assert len(u) == 3 and len(same[2]) == 1  # the first numbering fails
    # the check that sends a corpus to the next numbering
    df = spark.createDataFrame([("en", 5, "aa", 40), ("en", 5, "bb", 40), ("en", 6, "cc", 9)], "lang string, h long, word string, f long")
    from pyspark.sql import functions as F
    assert df.groupBy("lang", "h").agg(F.count("*").alias("c"), F.sum("f").alias("f")).where("c > 1 AND f >= 50").count() == 1


# ------------------------------------------------------------ neighbours (13)

def brute_neighbours(rows, k, every):
    fine = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine[i] = min(fine.get(i, tuple(v)), tuple(v))
    out = {}
    for q, v in fine.items():
        if q % every == 0:
            near = sorted((-float((np.array(v) * np.array(w)).sum()), i) for i, w in fine.items() if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def recall(got, want):
    hit = sum(len({s for _, s in got.get(q, [])} and [1 for _, s in got[q] if s >= w[-1][1] - 1e-12]) for q, w in want.items() if w)
    return hit / max(1, sum(len(w) for w in want.values()))


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


@pytest.mark.parametrize("kind", ["random", "norms", "clusters"])
def test_neighbours_recall(spark, kind):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 24))
    if kind == "norms":
        x *= rng.lognormal(size=(3000, 1))
    if kind == "clusters":
        x = x[rng.integers(0, 30, 3000)] + 0.05 * rng.normal(size=x.shape)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = collect(hnsw.neighbours(df, shard_rows=1100)), brute_neighbours(rows, 20, 20)
    assert set(got) == set(want) and recall(got, want) >= 0.95
    for q, found in got.items():  # exact scores, in order
        assert all(abs(s - float(x[q] @ x[i])) < 1e-9 for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and q not in [i for i, _ in found]


def test_neighbours_edges(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 6))
    v = [b.tolist() for b in base] + [base[0].tolist()] * 300 + [(base[1] * 1e160).tolist(), None, [], [0.0] * 6, [float("nan")] * 6,
                                                                [None] * 6, [float("inf")] * 6, [1.0, 2.0], [2.0, 1.0], [5.0]]
    rows = list(enumerate(v)) + [(None, base[3].tolist()), (20, base[5].tolist()), (20, base[20].tolist()), (400, [1.0, 1.0]), (420, [7.0])]
    df = spark.createDataFrame([(i, x, "a", 1, 2) for i, x in rows], "vec_id long, embedding array<double>, shard string, width int, rank int")
    got, want = collect(hnsw.neighbours(df, shard_rows=100)), brute_neighbours(rows, 20, 20)
    assert {q: [i for i, _ in f] for q, f in got.items()} == {q: [i for i, _ in f] for q, f in want.items() if f}
    assert len(got[0]) == 20 and [i for i, _ in got[40]][1:3] == sorted(i for i, _ in got[40][1:3])
    assert hnsw.neighbours(df.limit(0)).count() == 0


def test_graph_is_flat_arrays():
    x = np.random.default_rng(1).normal(size=(900, 8))
    g = hnsw.build(np.arange(900), x, 21)
    assert all(a.ndim == 1 and a.dtype == np.int32 for a in g.layers) and g.sizes[0] == 900 and g.sizes == sorted(g.sizes, reverse=True)
    for t, n in enumerate(g.sizes):
        near = g.places(t)
        assert near.shape == (n, hnsw.LINKS * (1 if t else 2)) and near.max() < n
        assert all(len(set(r[r >= 0])) == (r >= 0).sum() and i not in r for i, r in enumerate(near))


@pytest.mark.parametrize("held", [1000, 7])
def test_candidates_handed_on_once(monkeypatch, held):
    monkeypatch.setattr(collocations, "HELD", held)
    rng, sent, seen = np.random.default_rng(4), collocations.Sent(), set()
    for _ in range(40):
        g, v = rng.integers(0, 12, 15).astype(np.uint64), rng.integers(0, 2, 15).astype(np.uint64)
        _, first = np.unique(g * np.uint64(2) + v, return_index=True)
        g, v = g[first], v[first]
        fresh = set(sent.add(g, v).tolist())
        new = {i for i in range(len(g)) if (g[i], v[i]) not in seen}
        assert new <= fresh  # none is withheld
        seen |= set(zip(g, v))
        assert (np.diff(sent.g.astype(np.int64)) >= 0).all()
    words = np.array([[1, 2], [2, 1], [1, 2]])
    one = collocations.second(words, np.array([5, 5, 6], np.uint64))
    assert len(set(one.tolist())) == 3
