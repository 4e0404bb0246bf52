"""The separator cascade against a plain version that packs piece by piece."""

import random
import re

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wellspark.operators import retrieve


def brute(text, size, overlap):
    atoms = [text] if text else []
    for sep in (r"(?<=\n\n)(?!\n)", r"(?<=\n)(?!\n)", r"(?<= )(?! )", r""):
        atoms = [q for p in atoms for q in ([p] if len(p) <= size else re.split(sep, p)) if q]
    bounds, out, s, e = [0], [], 0, 0
    for a in atoms:
        x = e + len(a)
        if x - s > size:
            out.append((s, text[s:e]))
            s = min(b for b in bounds if b >= max(e - overlap, x - size))
        e = x
        bounds = [b for b in bounds if b >= e - size] + [e]
    return out + ([(s, text[s:e])] if e > s else [])


def random_text(rnd):
    def word():
        return "".join(rnd.choice("abcdé\U0001f600") for _ in range(rnd.choice((1, 2, 3, 5, 9, 30, 70))))
    return "".join(word() + rnd.choice((" ", " ", " ", "  ", "\n", "\n\n", "\n\n\n", "")) for _ in range(rnd.randint(1, 60)))


@pytest.mark.parametrize("size,overlap", [(500, 50), (40, 10), (20, 10), (7, 3), (5, 0), (1, 0)])
def test_cascade_equals_brute_force(spark, monkeypatch, size, overlap):
    monkeypatch.setattr(retrieve, "SEGMENT", 64)
    rnd = random.Random(size)
    texts = [random_text(rnd) for _ in range(60)] + ["x" * 1203, "x" * 700 + " y " + "z" * 900 + "\n\nend", " " * 90, "\n", ""]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(-1, None, "c")],
                               "doc_id long, text string, chunk string")
    got = retrieve.chunk_recursive(df, "doc_id", "text", size, overlap).collect()
    want = [(i, p, c) for i, t in enumerate(texts) for p, c in brute(t, size, overlap)]
    assert sorted((r.doc_id, r.pos, r.chunk) for r in got) == sorted(want)
    for i, t in enumerate(texts):
        seen = set().union(*[range(r.pos, r.pos + len(r.chunk)) for r in got if r.doc_id == i])
        assert seen == set(range(len(t)))
    assert all(len(r.chunk) <= size for r in got)


def test_cascade_edges(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c")], "doc_id long, text string")
    got = retrieve.chunk_recursive(df, "doc_id", "text")
    assert sorted(r.chunk for r in got.collect()) == ["a b", "c"]
    assert retrieve.chunk_recursive(df.limit(0), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        retrieve.chunk_recursive(df, "doc_id", "text", 10, 6)


def test_registered_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = E.queries()["chunk_cascade"](spark, SF_SMALL).collect()
    want = [(i, p, c) for i, t in docs.items() for p, c in brute(t or "", 500, 50)]
    assert sorted((r.doc_id, r.pos, r.chunk) for r in got) == sorted(want)
