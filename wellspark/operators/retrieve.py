"""Retrieval over documents: chunking, lexical re-ranking, context stuffing,
prompt rows.  Chunks, terms and scores are rows; every step is a join or a
grouped aggregate, so a large corpus and many questions spread over tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.session import cut_lineage

# The instruction text of a classification prompt and the
# role markers of the plain chat layout.
PROMPT_INSTRUCTION = "Classify the following text into one of these categories ({cats}):"
USER_TAG = "<|user|>"
ASSISTANT_TAG = "<|assistant|>"


def prompt_messages(text: Column, label: Column, cats: str) -> Column:
    """The two chat messages as an array of (role, content) structs."""
    user = F.concat(F.lit(PROMPT_INSTRUCTION.format(cats=cats) + "\n\nText: "), text)
    answer = F.concat(F.lit("Category: "), label)
    return F.array(F.struct(F.lit("user").alias("role"), user.alias("content")),
                   F.struct(F.lit("assistant").alias("role"), answer.alias("content")))


def prompt_format(df: DataFrame, text_col: str, label_col: str, cats: str) -> DataFrame:
    """Adds ``messages`` (JSON) and ``prompt`` (plain chat layout)."""
    msgs = prompt_messages(F.col(text_col), F.col(label_col), cats)
    prompt = F.concat(F.lit(USER_TAG + "\n"), msgs[0]["content"], F.lit("\n" + ASSISTANT_TAG + "\n"),
                      msgs[1]["content"])
    return df.withColumn("messages", F.to_json(msgs)).withColumn("prompt", prompt)


# ------------------------------------------------------------------ chunks

def chunk_stride(df: DataFrame, id_col: str, text_col: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Pieces of ``size`` characters starting every ``size - overlap``
    characters; one row per piece with (id, pos, chunk).  Whole texts, no
    prefix: the last piece ends at the end of the text."""
    step = size - overlap
    n = F.length(F.col(text_col))
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return (df.select(id_col, text_col, F.explode(starts).alias("pos"))
            .select(id_col, "pos", F.substring(F.col(text_col), F.col("pos") + 1, size).alias("chunk")))


# Ends of paragraphs, lines and words: a piece keeps the separators behind it.
CASCADE = (r"(?<=\n\n)(?!\n)", r"(?<=\n)(?!\n)", r"(?<= )(?! )")
# Characters a text is first taken apart into when chunks are cut out, so that
# a chunk far behind in a long text is not searched for from its beginning.
SEGMENT = 1 << 16


def _cascade_pieces(text: Column, size: int) -> Column:
    """Pieces that make up the text; only those too long meet the next separator."""
    out = F.array(text)
    for sep in CASCADE:
        out = F.flatten(F.transform(out, lambda p: F.when(F.char_length(p) <= size, F.array(p))
                                    .otherwise(F.split(p, sep))))
    return F.filter(out, lambda p: p != "")


def _packed(pieces: Column, size: int, overlap: int) -> Column:
    """(s, e) of every chunk: one fold over the pieces.  The state holds the open
    chunk [s, e), the piece boundaries of its last ``overlap`` characters (w),
    and the last stretch [f, g] that may be cut anywhere, out of a piece longer
    than ``size``."""
    ints = "array<int>"
    step = size - overlap

    def state(s, e, f, g, w, out):
        return F.struct(s.alias("s"), e.alias("e"), f.alias("f"), g.alias("g"), w.alias("w"), out.alias("out"))

    def span(s, e):
        return F.array(F.struct(s.alias("s"), e.alias("e")))

    def start(acc, least):
        """Smallest boundary that is not below ``least``."""
        free = F.when(acc["g"] >= least, F.greatest(acc["f"], least))
        return F.least(F.array_min(F.filter(acc["w"], lambda v: v >= least)), free)

    def add(acc, piece):
        x = acc["e"] + F.char_length(piece)
        window = F.concat(F.filter(acc["w"], lambda v: v >= x - overlap), F.array(x))
        longer = state(acc["s"], x, acc["f"], acc["g"], window, acc["out"])
        closed = state(F.coalesce(start(acc, F.greatest(acc["e"] - overlap, x - size)), acc["e"]), x, acc["f"],
                       acc["g"], window, F.concat(acc["out"], span(acc["s"], acc["e"])))
        full = acc["s"] + size  # a piece longer than a chunk fills the open one
        second = F.least(start(acc, full - overlap), F.greatest(acc["e"], full - overlap))
        more = F.greatest(F.lit(0), F.ceil((x - second - size) / step).cast("int"))
        cuts = F.when(more > 0, F.transform(F.sequence(F.lit(1), more), lambda k: F.struct(
            (second + (k - 1) * step).alias("s"), (second + (k - 1) * step + size).alias("e")))) \
            .otherwise(F.array().cast("array<struct<s:int,e:int>>"))
        cut = state(second + more * step, x, acc["e"], x, F.array().cast(ints),
                    F.concat(acc["out"], span(acc["s"], full), cuts))
        return F.when(F.char_length(piece) > size, cut).when(x - acc["s"] <= size, longer).otherwise(closed)

    zero = F.lit(0)
    first = state(zero, zero, zero, zero, F.array().cast(ints), F.array().cast("array<struct<s:int,e:int>>"))
    return F.aggregate(pieces, first, add, lambda acc: F.when(
        acc["e"] > acc["s"], F.concat(acc["out"], span(acc["s"], acc["e"]))).otherwise(acc["out"]))


def chunk_recursive(df: DataFrame, id_col: str, text_col: str, size: int = 500, overlap: int = 50) -> DataFrame:
    """Separator cascade with greedy packing: (id, pos, chunk), pos being the
    chunk's first character.

    A text is taken apart after paragraphs; pieces longer than ``size`` after
    lines, then after words, and what is still longer may be cut anywhere.
    Pieces are packed in order into chunks of at most ``size`` characters; a
    chunk starts with as much of the end of the one before as whole pieces of
    at most ``overlap`` characters give, also where a piece was taken apart
    further.  Every character is in a chunk, blanks and separators too.  All of
    it is built-in functions of one row, so nothing is shuffled.

    Defined results: no rows for a null or empty text; repeated ids give the
    chunks of each row; other columns are ignored."""
    if size < 1 or not 0 <= 2 * overlap <= size:
        raise ValueError("overlap must be at most half of size")
    src = df.select(F.col(id_col), F.col(text_col).alias("_text")).where(F.char_length("_text") > 0)
    text = F.col("_text")
    segments = F.transform(F.sequence(F.lit(0), F.char_length(text) - 1, F.lit(SEGMENT)),
                           lambda i: F.substring(text, i + 1, SEGMENT + size))
    spans = _packed(_cascade_pieces(text, size), size, overlap)

    def cut(c: Column, segs: Column) -> Column:
        seg = F.get(segs, F.floor(c["s"] / SEGMENT).cast("int"))
        return F.struct(c["s"].alias("pos"), F.substring(seg, c["s"] % SEGMENT + 1, c["e"] - c["s"]).alias("chunk"))

    # the one-element array keeps the segments from being made anew for every chunk
    chunks = F.flatten(F.transform(F.array(segments), lambda segs: F.transform(spans, lambda c: cut(c, segs))))
    return src.select(id_col, F.explode(chunks).alias("_c")).select(id_col, "_c.pos", "_c.chunk")


# --------------------------------------------------------------- postings

def postings(df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """(id, term, tf): the term counts of every row, built once and shared by
    the vectors and the lexical scores."""
    return (df.select(F.col(id_col).alias("_id"), F.explode(tokens).alias("term"))
            .groupBy("_id", "term").agg(F.count(F.lit(1)).alias("tf"))
            .withColumnRenamed("_id", id_col))


def hashed_vectors(post: DataFrame, id_col: str, dims: int = 64) -> DataFrame:
    """L2-normalised term-count vectors over ``dims`` md5 buckets (rows
    without tokens have no postings and get no vector) and ``dl``, the number
    of tokens.  One aggregate per row id collects (bucket, count) pairs; the
    vector is a numpy ``bincount`` per Arrow batch."""
    from wellspark.functions.columns import md5_bucket

    @F.pandas_udf("array<double>")
    def to_vec(bs: pd.Series, cs: pd.Series) -> pd.Series:
        return pd.Series([_unit(b, c, dims) for b, c in zip(bs, cs)])

    per = (post.withColumn("_b", md5_bucket(F.col("term"), dims))
           .groupBy(id_col).agg(F.collect_list("_b").alias("bs"), F.collect_list("tf").alias("cs"), F.sum("tf").alias("dl")))
    return per.select(id_col, to_vec("bs", "cs").alias("vec"), "dl")


def _unit(buckets, counts, dims: int) -> np.ndarray:
    v = np.bincount(np.asarray(buckets, dtype=np.int64),
                    weights=None if counts is None else np.asarray(counts, dtype=np.float64), minlength=dims).astype(float)
    return v / np.sqrt((v * v).sum())


FEW = 1_000_000  # ids or terms of a few bytes that go to every task; more are joined by a shuffle


def _listed(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= FEW else rows


def parted_by_id(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose id no other row has, the other rows and those without an id;
    null if there are none).  Only ids are shuffled."""
    counts = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("c"))
    again = cut_lineage(counts.where(F.col(id_col).isNull() | (F.col("c") > 1)).select(id_col))
    if again.isEmpty():
        return df, None
    known = _listed(again.where(F.col(id_col).isNotNull()))
    several = df.join(known, id_col, "left_semi").unionByName(df.where(F.col(id_col).isNull()))
    return df.where(F.col(id_col).isNotNull()).join(known, id_col, "left_anti"), several


def rows_of(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Rows with one of the ids; few ids go to the rows."""
    return df.join(_listed(ids.select(id_col).distinct()), id_col, "left_semi")


def text_vectors(single: DataFrame, several: DataFrame | None, id_col: str, tokens: Column, dims: int = 64) -> DataFrame:
    """``hashed_vectors`` of texts (parts of ``parted_by_id``).  A row of an id
    of its own makes its vector by itself, so its terms are not shuffled."""
    from wellspark.functions.columns import md5_bucket

    @F.pandas_udf("array<double>")
    def to_vec(bs: pd.Series) -> pd.Series:
        return pd.Series([_unit(b, None, dims) if len(b) else None for b in bs], dtype=object)

    buckets = F.transform(tokens, lambda t: md5_bucket(t, dims))
    out = single.select(id_col, buckets.alias("_b")).select(id_col, to_vec("_b").alias("vec"), F.size("_b").cast("long").alias("dl")) \
        .where("vec IS NOT NULL")
    return out if several is None else out.unionByName(hashed_vectors(postings(several, id_col, tokens), id_col, dims))


def document_frequency(single: DataFrame, several: DataFrame | None, id_col: str, tokens: Column, terms: DataFrame) -> DataFrame:
    """(term, df): ids that have each of ``terms`` (a column ``term``).  Other
    words go inside the tasks, and those left are counted there first."""
    wanted = _listed(terms)

    def hits(part: DataFrame) -> DataFrame:
        return part.select(id_col, F.explode(F.array_distinct(tokens)).alias("term")).join(wanted, "term", "left_semi")

    found = hits(single).select("term")
    if several is not None:
        found = found.unionByName(hits(several).distinct().select("term"))
    return found.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


# -------------------------------------------------------------------- BM25

def bm25_rerank(candidates: DataFrame, q_post: DataFrame, c_post: DataFrame, dfreq: DataFrame, avgdl: float | None,
                n_chunks: int, top: int = 3, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """Lexical score of (question, chunk) candidate pairs, best ``top`` per
    question.  ``c_post`` are the postings of the candidate chunks, ``dfreq``
    the document frequency of the question terms and ``avgdl`` the average
    length, both over all ``n_chunks`` chunks; only candidate pairs are
    scored, so the work is bounded by candidates x terms, not by questions x
    chunks."""
    qt = q_post.select("qid", "term")
    avgdl = F.lit(avgdl).cast("double")
    lens = c_post.groupBy("chunk_id").agg(F.sum("tf").alias("dl"))
    pairs = candidates.select("qid", "chunk_id").join(qt, "qid").join(c_post, ["chunk_id", "term"]) \
        .join(dfreq, "term").join(lens, "chunk_id")
    idf = F.log(1 + (F.lit(n_chunks) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    w = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / avgdl))
    # rounded so that equal chunks (copies) tie exactly whatever the sum order
    scores = pairs.groupBy("qid", "chunk_id").agg(F.round(F.sum(w), 9).alias("bm25"))
    allc = candidates.select("qid", "chunk_id").join(scores, ["qid", "chunk_id"], "left") \
        .withColumn("bm25", F.coalesce("bm25", F.lit(0.0)))
    best = allc.groupBy("qid").agg(F.slice(F.array_sort(F.collect_list(
        F.struct((-F.col("bm25")).alias("neg"), F.col("chunk_id")))), 1, top).alias("b"))
    return best.select("qid", F.posexplode("b").alias("p", "s")).select(
        "qid", (F.col("p") + 1).cast("int").alias("rank"), F.col("s.chunk_id").alias("chunk_id"),
        (-F.col("s.neg")).alias("bm25"))


def stuff_context(ranked: DataFrame, chunks: DataFrame, sep: str = "\n\n") -> DataFrame:
    """One prompt context per question: its chunks in rank order joined by
    ``sep`` (per-question groups hold ``top`` rows)."""
    j = ranked.join(chunks.select("chunk_id", "chunk"), "chunk_id")
    g = j.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("rank", "chunk"))).alias("r"))
    return g.select("qid", F.array_join(F.transform("r", lambda s: s["chunk"]), sep).alias("context"))
