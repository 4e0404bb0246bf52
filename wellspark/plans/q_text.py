"""Registered queries: text functions (2.9) and text features (2.12), over
the whole ``documents`` table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from wellspark.functions import text as X
from wellspark.operators import textfeat as TF
from wellspark.plans.registry import register
from wellspark.session import cut_lineage, text_batches
from wellspark.sources.tables import table

S = "text"

PUNCT_SQL = "'" + X.PUNCTUATION.replace("'", "''") + "'"
STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in X.STOP_WORDS_EN) + "]"


def _steps_sql(t: str) -> str:
    return (f"translate(regexp_replace(regexp_replace(lower({t}), 'http\\S+|www\\S+', '', 'g'), "
            f"'\\p{{Nd}}+', '', 'g'), {PUNCT_SQL}, '')")


def _tokens_sql(t: str) -> str:
    return f"list_filter(string_split_regex({t}, '\\s+'), lambda x: x <> '')"


def clean_tokens_sql(t: str) -> str:
    return f"list_filter({_tokens_sql(_steps_sql(t))}, lambda x: NOT list_contains({STOP_SQL}, x))"


def clean_text_sql(t: str) -> str:
    return f"array_to_string({clean_tokens_sql(t)}, ' ')"


def _docs(spark, sf):
    return table(spark, sf, "documents")


@register("txt_lower", S, "SELECT doc_id, lower(text) AS text FROM documents")
def q_txt_lower(spark, sf):
    return _docs(spark, sf).select("doc_id", X.txt_lower(F.col("text")).alias("text"))


@register("txt_strip_urls", S,
          "SELECT doc_id, regexp_replace(text, 'http\\S+|www\\S+', '', 'g') AS text FROM documents")
def q_txt_strip_urls(spark, sf):
    return _docs(spark, sf).select("doc_id", X.txt_strip_urls(F.col("text")).alias("text"))


@register("txt_strip_digits", S,
          "SELECT doc_id, regexp_replace(text, '\\p{Nd}+', '', 'g') AS text FROM documents")
def q_txt_strip_digits(spark, sf):
    return _docs(spark, sf).select("doc_id", X.txt_strip_digits(F.col("text")).alias("text"))


@register("txt_strip_punct", S, f"SELECT doc_id, translate(text, {PUNCT_SQL}, '') AS text FROM documents")
def q_txt_strip_punct(spark, sf):
    return _docs(spark, sf).select("doc_id", X.txt_strip_punct(F.col("text")).alias("text"))


@register("txt_letters_only", S,
          "SELECT doc_id, regexp_replace(text, '[^a-zA-Z\\s]', ' ', 'g') AS text FROM documents")
def q_txt_letters_only(spark, sf):
    return _docs(spark, sf).select("doc_id", X.txt_letters_only(F.col("text")).alias("text"))


@register("txt_tokens", S, f"""
SELECT doc_id, array_to_string({_tokens_sql('text')}, ' ') AS tokens,
  CAST(len({_tokens_sql('text')}) AS INTEGER) AS n_tokens FROM documents""")
def q_txt_tokens(spark, sf):
    t = X.txt_tokens(F.col("text"))
    return _docs(spark, sf).select("doc_id", F.array_join(t, " ").alias("tokens"),
                                   F.size(t).alias("n_tokens"))


@register("word_count", S, f"SELECT doc_id, CAST(len({_tokens_sql('text')}) AS INTEGER) AS n_words FROM documents")
def q_word_count(spark, sf):
    return _docs(spark, sf).select("doc_id", X.word_count(F.col("text")).alias("n_words"))


@register("txt_stopwords", S, f"""
SELECT doc_id, array_to_string(list_filter({_tokens_sql('lower(text)')},
  lambda x: NOT list_contains({STOP_SQL}, x)), ' ') AS tokens FROM documents""")
def q_txt_stopwords(spark, sf):
    t = X.txt_stopwords(X.txt_tokens(F.lower(F.col("text"))))
    return _docs(spark, sf).select("doc_id", F.array_join(t, " ").alias("tokens"))


@register("txt_clean_chain", S, f"SELECT doc_id, {clean_text_sql('text')} AS text_clean FROM documents")
def q_txt_clean_chain(spark, sf):
    return _docs(spark, sf).select("doc_id", X.clean_text(F.col("text")).alias("text_clean"))


@register("vocab_size", S, """
SELECT count(DISTINCT tok) AS vocab_size FROM (
  SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')) AS tok FROM documents)""")
def q_vocab_size(spark, sf):
    return TF.vocab_size(_docs(spark, sf), X.word_tokens(F.col("text")))


_CLEAN_WORDS_SQL = f"regexp_extract_all({clean_text_sql('text')}, '[\\p{{L}}\\p{{N}}_]{{2,}}')"


@register("top_ngrams", S, f"""
WITH t AS (SELECT {_CLEAN_WORDS_SQL} AS tok FROM documents),
g AS (SELECT 2 AS n, unnest(list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) AS ngram
      FROM t WHERE len(tok) >= 2
      UNION ALL
      SELECT 3 AS n, unnest(list_transform(range(1, len(tok) - 1),
        lambda i: tok[i] || ' ' || tok[i + 1] || ' ' || tok[i + 2])) AS ngram FROM t WHERE len(tok) >= 3),
c AS (SELECT n, ngram, count(*) AS cnt FROM g GROUP BY 1, 2)
SELECT n, ngram, cnt FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY cnt DESC, ngram) AS rk FROM c)
WHERE rk <= 10""")
def q_top_ngrams(spark, sf):
    toks = X.word_tokens(X.clean_text(F.col("text")))
    return TF.top_ngrams(_docs(spark, sf), toks, (2, 3), 10)


_GRAMS_SQL = f"""t AS (SELECT doc_id, {_CLEAN_WORDS_SQL} AS tok FROM documents),
g AS (SELECT doc_id, unnest(tok) AS term FROM t
      UNION ALL
      SELECT doc_id, unnest(list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) AS term
      FROM t WHERE len(tok) >= 2),
c AS (SELECT term, count(*) AS n FROM g GROUP BY 1),
v AS (SELECT term, n, CAST(row_number() OVER (ORDER BY n DESC, term) - 1 AS INTEGER) AS "index"
  FROM c ORDER BY n DESC, term LIMIT 20000)"""


@register("count_vectorize", S, f"""WITH {_GRAMS_SQL} SELECT term, n, "index" FROM v""")
def q_count_vectorize(spark, sf):
    toks = X.word_tokens(X.clean_text(F.col("text")))
    return TF.fit_vocabulary(_docs(spark, sf), toks, 20000, (1, 2))


@register("count_vectors", S, f"""WITH {_GRAMS_SQL}
SELECT g.doc_id, v."index", count(*) AS "count" FROM g JOIN v USING (term) GROUP BY 1, 2""")
def q_count_vectors(spark, sf):
    d, toks = _docs(spark, sf), X.word_tokens(X.clean_text(F.col("text")))
    vocab = cut_lineage(TF.fit_vocabulary(d, toks, 20000, (1, 2)))
    return TF.sparse_counts(d, "doc_id", toks, vocab, (1, 2))


@register("term_freq_by_class", S, f"""
WITH t AS (SELECT l.quality, unnest({clean_tokens_sql('d.text')}) AS term
           FROM documents d JOIN labels l USING (doc_id)),
c AS (SELECT quality, term, count(*) AS n FROM t GROUP BY 1, 2)
SELECT quality, term, n FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY n DESC, term) AS rk
  FROM c) WHERE rk <= 200""")
def q_term_freq_by_class(spark, sf):
    d = _docs(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    return TF.term_freq_by_class(d, "quality", X.clean_tokens(F.col("text")), 200)


_CATS = "de, en, es, fr"
_PROMPT_USER = "Classify the following text into one of these categories ({cats}):\n\nText: "
_PROMPT_SQL = (f"'<|user|>\n' || 'Classify the following text into one of these categories ({_CATS}):' || "
               f"chr(10) || chr(10) || 'Text: ' || text || chr(10) || '<|assistant|>' || chr(10) || "
               f"'Category: ' || lang")


@register("prompt_format", S, f"SELECT doc_id, {_PROMPT_SQL} AS prompt FROM documents")
def q_prompt_format(spark, sf):
    from wellspark.operators.retrieve import prompt_format
    return prompt_format(_docs(spark, sf), "text", "lang", _CATS).select("doc_id", "prompt")


@register("udf_batch", S, f"SELECT doc_id, {_PROMPT_SQL} AS prompt FROM documents")
@text_batches
def q_udf_batch(spark, sf):
    """The same prompt built by a batched pandas map (Arrow batches)."""
    user = _PROMPT_USER.format(cats=_CATS)

    def add_prompt(batches):
        for pdf in batches:
            yield pd.DataFrame({
                "doc_id": pdf["doc_id"],
                "prompt": "<|user|>\n" + user + pdf["text"] + "\n<|assistant|>\nCategory: " + pdf["lang"],
            })
    return _docs(spark, sf).select("doc_id", "text", "lang").mapInPandas(
        add_prompt, "doc_id long, prompt string")


@register("udf_scalar", S)
@text_batches
def q_udf_scalar(spark, sf):
    """Row function through a vectorized pandas UDF (Python regex), checked
    in tests against the native expression chain."""
    import re
    import string

    stop = set(X.STOP_WORDS_EN)
    table_ = str.maketrans("", "", string.punctuation)

    @F.pandas_udf("string")
    def clean(s: pd.Series) -> pd.Series:
        def one(t):
            t = re.sub(r"http\S+|www\S+", "", t.lower())
            t = re.sub(r"\d+", "", t).translate(table_)
            return " ".join(w for w in t.split() if w not in stop)
        return s.fillna("").map(one)
    return _docs(spark, sf).select("doc_id", clean("text").alias("text_clean"))


@register("round_output", S, """
SELECT event_id, round(value, 2) AS score, round(value / (value + 1.0::DOUBLE), 4) AS prob FROM events""")
def q_round_output(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.round("value", 2).alias("score"),
                     F.round(F.col("value") / (F.col("value") + 1.0), 4).alias("prob"))


def _rewrites_sql(w: str) -> str:
    return "[" + w + "".join(f", CASE WHEN {w} LIKE '%_{suf}' THEN left({w}, length({w}) - {len(suf)}) || '{rep}' END"
                             for suf, rep in X.NOUN_SUFFIX_RULES) + "]"


@register("txt_lemmas", S, f"""
WITH d AS (SELECT doc_id, {clean_tokens_sql('text')} AS toks FROM documents),
t AS (SELECT doc_id, unnest(toks) AS tok, generate_subscripts(toks, 1) AS pos FROM d),
v AS (SELECT DISTINCT tok FROM t),
c AS (SELECT tok, unnest({_rewrites_sql('tok')}) AS cand FROM v),
b AS (SELECT c.tok, arg_min(c.cand, (length(c.cand), c.cand)) AS lemma FROM c JOIN v ON v.tok = c.cand GROUP BY c.tok),
l AS (SELECT t.doc_id, string_agg(b.lemma, ' ' ORDER BY t.pos) AS text_lemmas FROM t JOIN b USING (tok) GROUP BY t.doc_id)
SELECT d.doc_id, coalesce(l.text_lemmas, '') AS text_lemmas FROM d LEFT JOIN l USING (doc_id)""")
@text_batches
def q_txt_lemmas(spark, sf):
    d = _docs(spark, sf).select("doc_id", X.clean_tokens(F.col("text")).alias("tokens"))
    return TF.lemmatize(d, "tokens").select(
        "doc_id", F.array_join("lemmas", " ").alias("text_lemmas"))


def _w2v_input(spark, sf):
    return _docs(spark, sf).select("doc_id", X.word_tokens(X.clean_text(F.col("text"))).alias("tokens"))


@register("word2vec", S)
def q_word2vec(spark, sf):
    model = TF.word2vec(_w2v_input(spark, sf), "tokens")
    from pyspark.ml.functions import vector_to_array
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


@register("similar_words", S)
def q_similar_words(spark, sf):
    d = _w2v_input(spark, sf)
    model = TF.word2vec(d, "tokens")
    targets = [r.term for r in TF.top_k(TF.term_counts(d, F.col("tokens")), 5,
                                        [F.desc("n"), F.asc("term")]).collect()]
    return TF.similar_words(model.getVectors(), targets + ["not_in_vocabulary"], 10)


@register("pca_2d", S)
def q_pca_2d(spark, sf):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    e = table(spark, sf, "embeddings").select("vec_id", array_to_vector("embedding").alias("features"))
    out = TF.pca_2d(e, "features", 2)
    return out.select("vec_id", vector_to_array("pca").alias("pca"))
