"""Validation rules and scoring of tables with fitted pipelines.

The reference validates one request at a time in a web handler; here the
same rules are boolean columns over a whole table or stream, and rejected
rows go to a side table with their reasons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.functions.columns import all_of


def validate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``is_valid`` and ``reject_reason`` (comma-joined names of failed
    rules; a rule that evaluates to null counts as failed)."""
    ok = {name: F.coalesce(pred, F.lit(False)) for name, pred in rules.items()}
    reasons = [F.when(~p, F.lit(name)) for name, p in ok.items()]
    return df.withColumns({
        "is_valid": all_of(list(ok.values())),
        "reject_reason": F.concat_ws(",", *reasons),
    })


def split_valid(df: DataFrame, rules: dict[str, Column]):
    checked = validate(df, rules)
    return (checked.where("is_valid").drop("is_valid", "reject_reason"),
            checked.where(~F.col("is_valid")))


# Persona descriptions attached to cluster ids (our own
# wording), and the default for an unknown cluster.
PERSONAS = [
    (0, "Balanced user", "moderate daily use", "regular sleep, few notifications", "low"),
    (1, "Notification driven", "frequent checks", "many notifications, short sessions", "medium"),
    (2, "Late-night scroller", "long evening sessions", "use after midnight, less sleep", "high"),
    (3, "Active minimalist", "little screen time", "much offline activity", "low"),
    (4, "Heavy multi-platform user", "many platforms", "long sessions on several apps", "high"),
]
UNKNOWN_PERSONA = ("Unknown profile", "not described", "not described", "unknown")


def persona_table(spark):
    return spark.createDataFrame(PERSONAS, "cluster int, nombre string, perfil string, patron string, impacto string")


def join_lookup(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str = "cluster") -> DataFrame:
    """Attach the descriptive fields of a lookup table; unknown ids get the
    default texts.  The planner broadcasts the table only if its size allows."""
    cols = [c for c in lookup.columns if c != lookup_key]
    j = df.join(lookup.withColumnRenamed(lookup_key, "_k"), F.col(key) == F.col("_k"), "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in zip(cols, UNKNOWN_PERSONA)}).drop("_k")


def score_classes(model, df: DataFrame, labels: list[str], key: str, carry: list[str] | None = None) -> DataFrame:
    """Predicted class name and a class -> probability map (rounded 4), with the
    columns ``carry`` of the same row."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    names = F.array(*[F.lit(x) for x in labels])
    probs = F.map_from_arrays(names, F.transform(vector_to_array("probability"), lambda p: F.round(p, 4)))
    return out.select(key, F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"),
                      probs.alias("probs"), *(carry or []))


def centre_distances(vec: "F.Column", centres) -> "F.Column":
    """Euclidean distance to each (bounded, broadcast-as-literal) centre."""
    dists = []
    for c in centres:
        lit = F.array(*[F.lit(float(x)) for x in c])
        sq = F.aggregate(F.zip_with(vec, lit, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        dists.append(F.round(F.sqrt(sq), 4))
    return F.array(*dists)


def score_clusters(model, df: DataFrame, key: str, features: str = "features") -> DataFrame:
    """Cluster id, persona and the distance to every centre."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df).withColumn("_v", vector_to_array(features))
    out = out.select(key, F.col("prediction").alias("cluster"),
                     centre_distances(F.col("_v"), model.clusterCenters()).alias("distances"))
    return join_lookup(out, "cluster", persona_table(df.sparkSession))
