"""Digest queries of the training-text operators, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wellspark.llm import collocations, quotes
from wellspark.llm.common import held_out, text_batches
from wellspark.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import language

    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import minhash

    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, num=85, den=100)


def op3_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_order(table(spark, sf_dir, "conversations"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import secrets

    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import quality

    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "score", "predicted")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import decontaminate

    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import repeats

    return repeats.remove_repeats(table(spark, sf_dir, "documents"), size=200)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted", "n_clauses")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from wellspark.llm import bpe

    return bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), digest=True)


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import embeddings

    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import runs

    return runs.digest(runs.find_runs(runs.echoed(table(spark, sf_dir, "documents"))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wellspark.llm import hnsw

    return hnsw.neighbours(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, QueryFn] = {
    "op1_language": text_batches(op1_language),
    "op2_minhash": text_batches(op2_minhash),
    "op3_quotes": text_batches(op3_quotes),
    "op4_secrets": text_batches(op4_secrets),
    "op5_quality": text_batches(op5_quality),
    "op6_decontaminate": text_batches(op6_decontaminate),
    "op7_repeats": text_batches(op7_repeats),
    "op8_toxicity": text_batches(op8_toxicity),
    "op9_bpe": text_batches(op9_bpe),
    "op10_embeddings": text_batches(op10_embeddings),
    "op11_runs": text_batches(op11_runs),
    "op12_collocations": text_batches(op12_collocations),
    "op13_neighbours": text_batches(op13_neighbours),
}

_SHINGLES = r"""
    SELECT DISTINCT {id}, CASE WHEN len(w) < {n} THEN array_to_string(w, ' ')
           ELSE array_to_string(w[i:i + {n} - 1], ' ') END AS s
    FROM (SELECT {id}, w, unnest(range(1, greatest(len(w) - {n} + 1, 1) + 1)) AS i
          FROM (SELECT {id}, regexp_extract_all({lowered}, '[^\x20\x09-\x0D]+') AS w
                FROM {table} WHERE {id} IS NOT NULL AND text IS NOT NULL) t WHERE len(w) > 0) u
"""

SQL: dict[str, str] = {
    "op3_quotes": quotes.SQL,
    "op12_collocations": collocations.SQL,
    "op6_decontaminate": f"""
        WITH d AS ({_SHINGLES.format(id="doc_id", n=5, table="documents", lowered="lower(text)")}),
             b AS ({_SHINGLES.format(id="item_id", n=5, table="benchmark", lowered="lower(text)")}),
             n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
        SELECT doc_id, item_id, count(*) AS n_common, any_value(n_item) AS n_item
        FROM d JOIN b USING (s) JOIN n USING (item_id)
        GROUP BY doc_id, item_id HAVING count(*) * 100 >= any_value(n_item) * 80
    """,
}
