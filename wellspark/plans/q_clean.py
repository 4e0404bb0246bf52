"""Registered queries: projections, filters, cleaning (survey 2.2, 2.3, 2.9
cleaning rows, 2.11 imputation) and the flagship IQR retention report."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellspark.functions import columns as C
from wellspark.operators import clean
from wellspark.plans.fixtures import (FLAG01, PRIO_NULL, QTY_NULL,
                                      SURVEY_LINEITEM_SQL, SURVEY_ORDERS_SQL,
                                      YES_NO, bucket_sql, split_col, split_sql,
                                      survey_lineitem, survey_orders)
from wellspark.plans.registry import register
from wellspark.sources.tables import table

S = "clean"

# ------------------------------------------------------------- flagship (7.2)

_EV_SPLIT = split_sql("event_id")
_EV_LIMITS = f"""
WITH b AS (SELECT event_id, value, {_EV_SPLIT} AS split FROM events),
q AS (SELECT quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
      FROM b WHERE split = 'train'),
l AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
"""


def events_retention(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value", split_col("event_id").alias("split"))
    train = ev.where(F.col("split") == "train")
    test = ev.where(F.col("split") == "test")
    limits = clean.iqr_limits(train, 1.5, cols=["value"])
    return clean.retention_report({"train": train, "test": test}, clean.iqr_predicate(limits))


register("retention_report", S, _EV_LIMITS + """
SELECT split, count(*) AS rows_before,
       count(*) FILTER (WHERE value BETWEEN lo AND hi) AS rows_kept,
       count(*) - count(*) FILTER (WHERE value BETWEEN lo AND hi) AS rows_removed,
       round((count(*) - count(*) FILTER (WHERE value BETWEEN lo AND hi)) * 100.0::DOUBLE
             / count(*), 4) AS pct_removed,
       'iqr' AS step
FROM b, l GROUP BY split""")(events_retention)


@register("iqr_filter", S, _EV_LIMITS + """
SELECT event_id, value, split FROM b, l WHERE value BETWEEN lo AND hi""")
def q_iqr_filter(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value", split_col("event_id").alias("split"))
    limits = clean.iqr_limits(ev.where(F.col("split") == "train"), 1.5, cols=["value"])
    return clean.iqr_filter(ev, limits)


_LI_NUM = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax"]


@register("iqr_limits", S, "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", q1 - 2.0::DOUBLE * (q3 - q1) AS lower, q3 + 2.0::DOUBLE * (q3 - q1) AS upper
    FROM (SELECT quantile_disc(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_disc(CAST({c} AS DOUBLE), 0.75) AS q3
          FROM lineitem WHERE {bucket_sql('l_orderkey')} < 80)""" for c in _LI_NUM) + ")")
def q_iqr_limits(spark, sf):
    li = table(spark, sf, "lineitem")
    train = li.where(split_col("l_orderkey") == "train")
    limits = clean.iqr_limits(train, 2.0)
    return spark.createDataFrame([(c, float(lo), float(hi)) for c, (lo, hi) in limits.items()],
                                 "column string, lower double, upper double")


@register("null_audit", S, "SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in
    ["l_orderkey", "l_linenumber", "qty", "l_extendedprice", "l_discount", "l_tax",
     "l_returnflag", "l_linestatus"]) + f" FROM {SURVEY_LINEITEM_SQL}")
def q_null_audit(spark, sf):
    return clean.null_audit(survey_lineitem(spark, sf))


@register("drop_null_rows", S, f"""
SELECT * FROM {SURVEY_ORDERS_SQL} WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL
AND o_orderstatus IS NOT NULL AND o_totalprice IS NOT NULL AND prio IS NOT NULL AND answer IS NOT NULL""")
def q_drop_null_rows(spark, sf):
    return clean.drop_null_rows(survey_orders(spark, sf))


@register("filter_not_null", S,
          f"SELECT l_orderkey, l_linenumber, qty FROM {SURVEY_LINEITEM_SQL} WHERE qty IS NOT NULL")
def q_filter_not_null(spark, sf):
    return clean.filter_not_null(survey_lineitem(spark, sf), "qty").select(
        "l_orderkey", "l_linenumber", "qty")


@register("filter_in_set", S, """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def q_filter_in_set(spark, sf):
    return table(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")) \
        .select("o_orderkey", "o_orderpriority")


@register("filter_not_in_set", S, f"""
SELECT o_orderkey, prio FROM {SURVEY_ORDERS_SQL} WHERE NOT coalesce(prio IN ('1-URGENT'), false)""")
def q_filter_not_in_set(spark, sf):
    return survey_orders(spark, sf).where(C.not_in_keep_null(F.col("prio"), ["1-URGENT"])) \
        .select("o_orderkey", "prio")


_ALLOWED_TYPES = ["click", "view", "purchase", "signup"]
_DOMAIN_SQL = f"""
SELECT event_id,
  (event_type IN ('click', 'view', 'purchase', 'signup')) AND (value BETWEEN 0 AND 400)
    AND user_id IS NOT NULL AS is_valid,
  concat_ws(',',
    CASE WHEN NOT (event_type IN ('click', 'view', 'purchase', 'signup')) THEN 'event_type' END,
    CASE WHEN NOT (value BETWEEN 0 AND 400) THEN 'value' END,
    CASE WHEN user_id IS NULL THEN 'user_id' END) AS reject_reason
FROM events"""


@register("filter_domain", S, _DOMAIN_SQL)
def q_filter_domain(spark, sf):
    from wellspark.operators.score import validate
    rules = {
        "event_type": F.col("event_type").isin(*_ALLOWED_TYPES),
        "value": F.col("value").between(0, 400),
        "user_id": F.col("user_id").isNotNull(),
    }
    return validate(table(spark, sf, "events"), rules).select("event_id", "is_valid", "reject_reason")


# ------------------------------------------------------------------ projections

@register("drop_leakage", S, "SELECT o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def q_drop_leakage(spark, sf):
    from wellspark.operators.encode import drop_leakage
    x, _y = drop_leakage(table(spark, sf, "orders"), target="o_totalprice",
                         drop=["o_orderkey", "not_a_column"])
    return x


@register("select_by_type", S, """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem""")
def q_select_by_type(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(C.columns_of_type(li, "numeric"))


@register("map_columns", S, """
SELECT l_orderkey, l_linenumber, l_quantity * 2.0::DOUBLE AS l_quantity,
  l_extendedprice * 2.0::DOUBLE AS l_extendedprice, l_discount * 2.0::DOUBLE AS l_discount,
  l_tax * 2.0::DOUBLE AS l_tax FROM lineitem""")
def q_map_columns(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                            "l_extendedprice", "l_discount", "l_tax")
    return C.map_columns(li, C.columns_of_type(li, "fractional"), lambda c: c * 2.0)


_FLAG_TEXT = ("CASE event_id % 4 WHEN 0 THEN '1' WHEN 1 THEN 'true ' WHEN 2 THEN ' False' "
              "ELSE 'x' END")


@register("one_zero_bool", S, f"""
SELECT event_id, CASE WHEN lower(trim({_FLAG_TEXT}, ' ')) IN ('1', 'true') THEN true
  WHEN lower(trim({_FLAG_TEXT}, ' ')) IN ('0', 'false') THEN false ELSE NULL END AS flag
FROM events""")
def q_one_zero_bool(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", C.one_zero_bool(F.expr(_FLAG_TEXT)).alias("flag"))


@register("bool_to_int", S, f"""
SELECT event_id, CAST(CASE WHEN {FLAG01.replace('STRING', 'VARCHAR')} = '1' THEN true ELSE false END AS INTEGER)
  AS flag FROM events""")
def q_bool_to_int(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", C.bool_to_int(C.one_zero_bool(F.expr(FLAG01))).alias("flag"))


@register("to_number_or_null", S, """
SELECT event_id, TRY_CAST(replace(replace(props, '{"k": ', ''), '}', '') AS DOUBLE) AS k_num,
  TRY_CAST(event_type AS DOUBLE) AS type_num FROM events""")
def q_to_number_or_null(spark, sf):
    ev = table(spark, sf, "events")
    k = F.replace(F.replace(F.col("props"), F.lit('{"k": '), F.lit("")), F.lit("}"), F.lit(""))
    return ev.select("event_id", C.to_number_or_null(k).alias("k_num"),
                     C.to_number_or_null(F.col("event_type")).alias("type_num"))


_EXPECTED = ["o_totalprice", "o_custkey", "flag_a", "o_orderstatus", "flag_b"]


@register("align_columns", S,
          "SELECT o_totalprice, o_custkey, 0 AS flag_a, o_orderstatus, 0 AS flag_b FROM orders")
def q_align_columns(spark, sf):
    from wellspark.operators.encode import align_columns
    return align_columns(table(spark, sf, "orders"), _EXPECTED)


_NAMES = {0: "none", 1: "low", 2: "mid", 3: "high", 4: "top"}


@register("decode_label", S, """
SELECT event_id, coalesce(CASE user_id % 7 WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'mid'
  WHEN 3 THEN 'high' WHEN 4 THEN 'top' END, 'Desconocido') AS label_name FROM events""")
def q_decode_label(spark, sf):
    from wellspark.operators.encode import decode_label
    ev = table(spark, sf, "events").select("event_id", (F.col("user_id") % 7).cast("int").alias("code"))
    return decode_label(ev, "code", _NAMES, out="label_name").select("event_id", "label_name")


def _persona_sql():
    from wellspark.operators.score import PERSONAS, UNKNOWN_PERSONA
    vals = ", ".join("(" + ", ".join([str(r[0])] + ["'" + x.replace("'", "''") + "'" for x in r[1:]]) + ")"
                     for r in PERSONAS)
    d = ["'" + x + "'" for x in UNKNOWN_PERSONA]
    return f"""
SELECT e.event_id, e.cluster, coalesce(p.nombre, {d[0]}) AS nombre, coalesce(p.perfil, {d[1]}) AS perfil,
  coalesce(p.patron, {d[2]}) AS patron, coalesce(p.impacto, {d[3]}) AS impacto
FROM (SELECT event_id, CAST(user_id % 7 AS INTEGER) AS cluster FROM events) e
LEFT JOIN (VALUES {vals}) p(cluster, nombre, perfil, patron, impacto) ON e.cluster = p.cluster"""


@register("join_lookup", S, _persona_sql())
def q_join_lookup(spark, sf):
    from wellspark.operators.score import join_lookup, persona_table
    ev = table(spark, sf, "events").select("event_id", (F.col("user_id") % 7).cast("int").alias("cluster"))
    return join_lookup(ev, "cluster", persona_table(spark))


# --------------------------------------------------------------- scalar cleaning

@register("std_text", S, f"""
SELECT o_orderkey, upper(trim(o_orderstatus, ' ')) AS o_orderstatus, upper(trim(prio, ' ')) AS prio,
  upper(trim(answer, ' ')) AS answer FROM {SURVEY_ORDERS_SQL}""")
def q_std_text(spark, sf):
    o = survey_orders(spark, sf).select("o_orderkey", "o_orderstatus", "prio", "answer")
    return C.map_columns(o, C.columns_of_type(o, "string"), C.std_text)


@register("round_decimals", S, """
SELECT l_orderkey, l_linenumber,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), 1) AS DOUBLE) AS l_extendedprice,
  CAST(round(CAST(l_quantity AS DECIMAL(18, 2)), 1) AS DOUBLE) AS l_quantity FROM lineitem""")
def q_round_decimals(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return C.map_columns(li, C.columns_of_type(li, "fractional"), lambda c: C.round_half_up(c, 1))


_ORD_SPLIT = split_sql("o_orderkey")
_MODE_SQL = f"""(SELECT v FROM (SELECT lower(trim(answer, ' ')) AS v, count(*) AS n FROM {SURVEY_ORDERS_SQL}
   WHERE answer IS NOT NULL AND {_ORD_SPLIT} = 'train' GROUP BY 1) ORDER BY n DESC, v LIMIT 1)"""


@register("yes_no_bool", S, f"""
SELECT o_orderkey, CASE WHEN lower(trim(answer, ' ')) = 'yes' THEN true
  WHEN lower(trim(answer, ' ')) = 'no' THEN false ELSE {_MODE_SQL} = 'yes' END AS answer
FROM {SURVEY_ORDERS_SQL}""")
def q_yes_no_bool(spark, sf):
    o = survey_orders(spark, sf)
    modes = clean.fit_binary_modes(o.where(split_col("o_orderkey") == "train"), ["answer"])
    return o.select("o_orderkey", C.yes_no_bool(F.col("answer"), modes["answer"]).alias("answer"))


@register("binary_mode", S, f"""
SELECT 'answer' AS "column", v AS value, n, v = 'yes' AS is_yes FROM (
  SELECT lower(trim(answer, ' ')) AS v, count(*) AS n FROM {SURVEY_ORDERS_SQL}
  WHERE answer IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1""")
def q_binary_mode(spark, sf):
    return clean.binary_mode(survey_orders(spark, sf), "answer")


@register("fill_constant", S, f"SELECT o_orderkey, coalesce(prio, 'unknown') AS prio FROM {SURVEY_ORDERS_SQL}")
def q_fill_constant(spark, sf):
    return clean.fill_constant(survey_orders(spark, sf), ["prio"]).select("o_orderkey", "prio")


_TEXT_NULL = "CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END"


@register("fill_empty", S, f"SELECT doc_id, coalesce({_TEXT_NULL}, '') AS text FROM documents")
def q_fill_empty(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", clean.fill_empty(F.expr(_TEXT_NULL)).alias("text"))


@register("map_values", S, """
SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN '5-LOW'
  WHEN '3-MEDIUM' THEN '2-HIGH' ELSE o_orderpriority END AS prio_group FROM orders""")
def q_map_values(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", C.map_values(F.col("o_orderpriority"),
                                               {"4-NOT SPECIFIED": "5-LOW", "3-MEDIUM": "2-HIGH"})
                    .alias("prio_group"))


# ------------------------------------------------------------------- imputation

_LI_SPLIT = split_sql("l_orderkey")


@register("median_fit", S, "SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median
    FROM {SURVEY_LINEITEM_SQL} WHERE {_LI_SPLIT} = 'train'""" for c in
    ["qty", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]) + ")")
def q_median_fit(spark, sf):
    li = survey_lineitem(spark, sf)
    cols = ["qty", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    med = clean.median_fit(li.where(split_col("l_orderkey") == "train"), cols)
    return spark.createDataFrame([(c, float(v)) for c, v in med.items()], "column string, median double")


@register("impute_fit_apply", S, f"""
WITH t AS (SELECT *, {_LI_SPLIT} AS split FROM {SURVEY_LINEITEM_SQL}),
m AS (SELECT quantile_cont(qty, 0.5) AS med FROM t WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split, coalesce(qty, med) AS qty FROM t, m""")
def q_impute_fit_apply(spark, sf):
    li = survey_lineitem(spark, sf).withColumn("split", split_col("l_orderkey"))
    imp = clean.Imputation(category_cols=[], median_cols=["qty"], bool_cols=[])
    imp.fit(li.where(F.col("split") == "train"))
    return imp.transform(li).select("l_orderkey", "l_linenumber", "split", "qty")


_PRICE_NULL = "CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE o_totalprice END"  # a survey number with gaps


@register("impute_all_kinds", S, f"""
WITH t AS (SELECT *, {_PRICE_NULL} AS price, {_ORD_SPLIT} AS split FROM {SURVEY_ORDERS_SQL}),
m AS (SELECT quantile_cont(price, 0.5) AS med FROM t WHERE split = 'train')
SELECT o_orderkey, split, coalesce(prio, '{clean.UNKNOWN}') AS prio, coalesce(price, med) AS price,
       CASE WHEN lower(trim(answer, ' ')) = 'yes' THEN true
            WHEN lower(trim(answer, ' ')) = 'no' THEN false ELSE {_MODE_SQL} = 'yes' END AS answer
FROM t, m""")
def q_impute_all_kinds(spark, sf):
    """Constant, median and mode learned on the training rows, applied to both parts."""
    o = survey_orders(spark, sf).withColumns({"split": split_col("o_orderkey"), "price": F.expr(_PRICE_NULL)})
    imp = clean.Imputation(category_cols=["prio"], median_cols=["price"], bool_cols=["answer"])
    imp.fit(o.where(F.col("split") == "train"))
    return imp.transform(o).select("o_orderkey", "split", "prio", "price", "answer")


__all__ = ["events_retention", "QTY_NULL", "PRIO_NULL", "YES_NO"]
