"""Registered queries: retrieval over documents (2.17): chunks of every
document, hashed term vectors, exact top-10 chunks per benchmark question,
BM25 re-rank to the best 3, and the stuffed context per question."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellspark.functions.text import word_tokens
from wellspark.operators import neighbors as NB
from wellspark.operators import retrieve as RT
from wellspark.plans.registry import register
from wellspark.session import cut_lineage
from wellspark.sources.tables import table

S = "retrieval"
DIMS = 64
WORDS = "'[\\p{L}\\p{N}_]{2,}'"

_CHUNK_SQL = """SELECT doc_id, CAST(pos AS INTEGER) AS pos, substr(text, pos + 1, 500) AS chunk FROM (
  SELECT doc_id, text, unnest(range(0, length(text), 450)) AS pos FROM documents)"""


@register("chunk_text", S, _CHUNK_SQL)
def q_chunk_text(spark, sf):
    return RT.chunk_stride(table(spark, sf, "documents"), "doc_id", "text", 500, 50)


@register("chunk_cascade", S)
def q_chunk_cascade(spark, sf):
    return RT.chunk_recursive(table(spark, sf, "documents"), "doc_id", "text", 500, 50)


def _chunks(spark, sf):
    # a position is below 2**30, so ids up to 9e9 give distinct chunk ids
    c = RT.chunk_stride(table(spark, sf, "documents"), "doc_id", "text", 500, 50)
    return c.select((F.col("doc_id") * 1000000000 + F.col("pos")).alias("chunk_id"), "chunk")


def _vec_sql(src: str, id_col: str, text_col: str) -> str:
    bucket = "(('0x' || substr(md5(tok), 1, 8))::BIGINT % 64)"
    arr = "[" + ", ".join(f"CAST(sum(CASE WHEN b = {i} THEN c ELSE 0 END) AS DOUBLE)" for i in range(DIMS)) + "]"
    return f"""(SELECT id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS v FROM (
  SELECT id, {arr} AS v FROM (
    SELECT id, {bucket} AS b, count(*) AS c FROM (
      SELECT {id_col} AS id, unnest(regexp_extract_all(lower({text_col}), {WORDS})) AS tok FROM {src})
    GROUP BY 1, 2) GROUP BY id))"""


_CH = f"(SELECT doc_id * 1000000000 + pos AS chunk_id, chunk FROM ({_CHUNK_SQL}))"
_TOP10 = f"""(SELECT qid, chunk_id FROM (
  SELECT q.id AS qid, c.id AS chunk_id,
    row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.v, c.v), c.id) AS rk
  FROM {_vec_sql('benchmark', 'item_id', 'text')} q JOIN {_vec_sql(_CH, 'chunk_id', 'chunk')} c ON true)
  WHERE rk <= 10)"""
_RERANK = f"""
WITH ct AS (SELECT chunk_id, regexp_extract_all(lower(chunk), {WORDS}) AS toks FROM {_CH}),
st AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM ct),
tf AS (SELECT chunk_id, term, count(*) AS tf FROM (SELECT chunk_id, unnest(toks) AS term FROM ct) GROUP BY 1, 2),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
ln_ AS (SELECT chunk_id, len(toks) AS dl FROM ct),
qt AS (SELECT DISTINCT item_id AS qid, unnest(regexp_extract_all(lower(text), {WORDS})) AS term FROM benchmark),
cand AS {_TOP10},
sc AS (SELECT cand.qid, cand.chunk_id,
    sum(ln(1 + (st.n - dfq.df + 0.5) / (dfq.df + 0.5)) * tf.tf * 2.5
        / (tf.tf + 1.5 * (1 - 0.75 + 0.75 * ln_.dl / st.avgdl))) AS bm25
  FROM cand JOIN qt ON qt.qid = cand.qid JOIN tf ON tf.chunk_id = cand.chunk_id AND tf.term = qt.term
  JOIN dfq ON dfq.term = qt.term JOIN ln_ ON ln_.chunk_id = cand.chunk_id, st GROUP BY 1, 2),
al AS (SELECT cand.qid, cand.chunk_id, round(coalesce(sc.bm25, 0.0), 9) AS bm25 FROM cand
  LEFT JOIN sc ON sc.qid = cand.qid AND sc.chunk_id = cand.chunk_id),
rk AS (SELECT qid, CAST(row_number() OVER (PARTITION BY qid ORDER BY bm25 DESC, chunk_id) AS INTEGER) AS rank,
  chunk_id, bm25 FROM al)
"""


def _ranked(spark, sf):
    ch = _chunks(spark, sf)
    q = table(spark, sf, "benchmark").select(F.col("item_id").alias("qid"), "text")
    q_post = RT.postings(q, "qid", word_tokens(F.col("text")))
    qv = RT.hashed_vectors(q_post, "qid", DIMS)
    # terms of a chunk stay inside its row; written once are its vector and length
    toks = word_tokens(F.col("chunk"))
    single, several = RT.parted_by_id(ch, "chunk_id")
    cv = cut_lineage(RT.text_vectors(single, several, "chunk_id", toks, DIMS))
    cand = cut_lineage(NB.knn(qv, cv, 10, "qid", "chunk_id", "vec").select("qid", F.col("nid").alias("chunk_id")))
    n, total = ch.count(), cv.agg(F.sum("dl")).first()[0]
    near = RT.rows_of(ch, cand, "chunk_id")
    dfreq = RT.document_frequency(single, several, "chunk_id", toks, cut_lineage(q_post.select("term").distinct()))
    r = RT.bm25_rerank(cand, q_post, RT.postings(near, "chunk_id", toks), dfreq, total / n if total else None, n, top=3)
    return r, near


@register("rerank", S, _RERANK + "SELECT qid, rank, chunk_id, bm25 FROM rk WHERE rank <= 3")
def q_rerank(spark, sf):
    r, _ch = _ranked(spark, sf)
    return r.select("qid", "rank", "chunk_id", F.round("bm25", 9).alias("bm25"))


@register("stuff_context", S, _RERANK + f"""
SELECT qid, string_agg(chunk, chr(10) || chr(10) ORDER BY rank) AS context
FROM rk JOIN {_CH} c USING (chunk_id) WHERE rank <= 3 GROUP BY qid""")
def q_stuff_context(spark, sf):
    r, ch = _ranked(spark, sf)
    return RT.stuff_context(r, ch)
