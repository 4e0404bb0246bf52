"""Stand-ins for the reference's survey tables, derived from the test tables.

Each derived column is ONE SQL expression string used verbatim by Spark
(``F.expr``) and by the DuckDB oracle, so both engines compute the same
thing over the whole table (no row subsets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspark.sources.tables import table

# md5 bucket of a key, in [0, 100): the oracle-safe split rule.
SPARK_BUCKET = "pmod(cast(conv(substr(md5(cast({k} as string)), 1, 8), 16, 10) as bigint), 100)"
SQL_BUCKET = "(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8))::BIGINT % 100)"

# Survey numbers with nulls, categories with nulls, yes/no text, 0/1 flags.
QTY_NULL = "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END"
PRIO_NULL = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END"
YES_NO = ("CASE o_orderkey % 5 WHEN 0 THEN ' Yes' WHEN 1 THEN 'no ' WHEN 2 THEN 'YES' "
          "WHEN 3 THEN NULL ELSE 'maybe' END")
FLAG01 = "CAST(event_id % 2 AS STRING)"
FLAG01_SQL = "CAST(event_id % 2 AS VARCHAR)"


def bucket_expr(k: str) -> str:
    return SPARK_BUCKET.format(k=k)


def bucket_sql(k: str) -> str:
    return SQL_BUCKET.format(k=k)


def split_col(k: str, train_pct: int = 80):
    return F.when(F.expr(bucket_expr(k)) < train_pct, F.lit("train")).otherwise(F.lit("test"))


def split_sql(k: str, train_pct: int = 80) -> str:
    return f"CASE WHEN {bucket_sql(k)} < {train_pct} THEN 'train' ELSE 'test' END"


def survey_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """Numeric survey stand-in with nulls in ``qty``."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(QTY_NULL).alias("qty"), "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus")


SURVEY_LINEITEM_SQL = (f"(SELECT l_orderkey, l_linenumber, {QTY_NULL} AS qty, l_extendedprice, "
                       "l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem)")


def survey_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Categorical survey stand-in: nullable priority, yes/no answers."""
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.expr(PRIO_NULL).alias("prio"), F.expr(YES_NO).alias("answer"))


SURVEY_ORDERS_SQL = (f"(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
                     f"{PRIO_NULL} AS prio, {YES_NO} AS answer FROM orders)")


def labeled_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with a status: documents joined to their labels."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")


# Raw request rows: every field is text, some are missing, no number, out of
# range or of an unknown value.
USAGE_REQUEST = """l_orderkey, l_linenumber, l_extendedprice AS wellbeing,
    CASE WHEN l_extendedprice < 20000 THEN 'Low' WHEN l_extendedprice < 40000 THEN 'Moderate'
         WHEN l_extendedprice < 60000 THEN 'High' ELSE 'Severe' END AS level,
    CASE WHEN l_orderkey % 13 = 0 THEN 'n/a' WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_orderkey % 29 = 0 THEN '-5'
         ELSE concat(' ', CAST(l_quantity AS STRING)) END AS hours,
    CAST(l_discount AS STRING) AS late, CASE WHEN l_orderkey % 7 = 0 THEN '' ELSE CAST(l_tax AS STRING) END AS sleep,
    CASE WHEN l_orderkey % 19 = 0 THEN 'zz' WHEN l_orderkey % 23 = 0 THEN '' ELSE concat(lower(l_linestatus), ' ') END AS platform,
    l_returnflag AS job"""
USAGE_NUMBERS = {"hours": [0, 60, False], "late": [0, 1, True], "sleep": [None, None, False]}
USAGE_CHOICES = {"platform": [["F", "O"], False], "job": [None, True]}

HEALTH_REQUEST = """o_orderkey, CAST(o_custkey % 22 AS DOUBLE) AS anxiety, CAST(o_custkey % 28 AS DOUBLE) AS depression,
    CASE WHEN o_custkey % 22 < 5 THEN 'MINIMAL' WHEN o_custkey % 22 < 10 THEN 'MILD'
         WHEN o_custkey % 22 < 15 THEN 'MODERATE' ELSE 'SEVERE' END AS anxiety_level,
    CASE WHEN o_custkey % 28 < 5 THEN 'NONE-MINIMAL' WHEN o_custkey % 28 < 10 THEN 'MILD' WHEN o_custkey % 28 < 15 THEN 'MODERATE'
         WHEN o_custkey % 28 < 20 THEN 'MODERATELY SEVERE' ELSE 'SEVERE' END AS depression_level,
    CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_totalprice AS STRING) END AS spent,
    CASE WHEN o_orderkey % 31 = 0 THEN '13' ELSE CAST(month(o_orderdate) AS STRING) END AS month,
    CASE WHEN o_orderkey % 19 = 0 THEN 'whatever' WHEN o_orderkey % 23 = 0 THEN NULL ELSE lower(o_orderpriority) END AS kind,
    CASE WHEN o_orderkey % 37 = 0 THEN ' ' ELSE o_orderstatus END AS status"""
HEALTH_KINDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
HEALTH_NUMBERS = {"spent": [0, 10000000, False], "month": [1, 12, True]}
HEALTH_CHOICES = {"kind": [HEALTH_KINDS, False], "status": [None, True]}


def usage_requests(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").selectExpr(f"struct({USAGE_REQUEST}) AS r", "l_orderkey").select("r.*", split_col("l_orderkey").alias("split"))


def health_requests(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(f"struct({HEALTH_REQUEST}) AS r", "o_orderkey").select("r.*", split_col("o_orderkey").alias("split"))


# The rules above in SQL: the reasons of a health request, and its fields.
HEALTH_CHECKED_SQL = f"""(SELECT *, concat_ws(', ',
    CASE WHEN trim(coalesce(spent, '')) = '' THEN NULL WHEN TRY_CAST(trim(spent) AS DOUBLE) IS NULL THEN 'spent: not a number'
         WHEN TRY_CAST(trim(spent) AS DOUBLE) NOT BETWEEN 0 AND 10000000 THEN 'spent: out of range' END,
    CASE WHEN trim(coalesce(month, '')) = '' THEN 'month: missing' WHEN TRY_CAST(trim(month) AS DOUBLE) IS NULL THEN 'month: not a number'
         WHEN TRY_CAST(trim(month) AS DOUBLE) NOT BETWEEN 1 AND 12 THEN 'month: out of range' END,
    CASE WHEN trim(coalesce(kind, '')) = '' THEN NULL
         WHEN upper(trim(kind)) NOT IN ({', '.join(f"'{k}'" for k in HEALTH_KINDS)}) THEN 'kind: unknown value' END,
    CASE WHEN trim(coalesce(status, '')) = '' THEN 'status: missing' END) AS reason
    FROM (SELECT {HEALTH_REQUEST}, {split_sql('o_orderkey')} AS split FROM orders) t)"""
