"""Column-level helpers.  Everything returns native Column expressions so the
plan stays inside whole-stage codegen; nothing here runs Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, FloatType, NumericType,
                               StringType)

# The null replacement for categories and the fallback label.
UNKNOWN = "unknown"
FALLBACK_LABEL = "Desconocido"


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by type class: 'numeric' (booleans excluded), 'string',
    'fractional' (float/double), 'boolean'."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if kind == "numeric" and isinstance(t, NumericType):
            out.append(f.name)
        elif kind == "string" and isinstance(t, StringType):
            out.append(f.name)
        elif kind == "fractional" and isinstance(t, (DoubleType, FloatType)):
            out.append(f.name)
        elif kind == "boolean" and isinstance(t, BooleanType):
            out.append(f.name)
    return out


def map_columns(df: DataFrame, cols: list[str], fn) -> DataFrame:
    """Apply one expression builder to many columns in a single Project."""
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def md5_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets) from the first 32 bits of md5(key).
    Independent of partitioning, identical to the SQL form
    ``('0x' || substr(md5(k::VARCHAR), 1, 8))::BIGINT % buckets``."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def bool_to_int(c: Column) -> Column:
    return c.cast("int")


def to_number_or_null(c: Column) -> Column:
    """Coerce to double; unparsable text gives null (ANSI cast would raise)."""
    return c.try_cast("double")


def std_text(c: Column) -> Column:
    """Upper-case and trim spaces (tabs stay, as ``trim`` does)."""
    return F.upper(F.trim(c))


def round_half_up(c: Column, scale: int) -> Column:
    """HALF_UP on the decimal form of the value (Spark ``round``)."""
    return F.round(c, scale)


def yes_no_bool(c: Column, mode_value: bool) -> Column:
    """'yes' -> true, 'no' -> false, anything else (null included) -> the
    fitted train mode."""
    v = F.trim(F.lower(c))
    return (F.when(v == "yes", F.lit(True))
            .when(v == "no", F.lit(False))
            .otherwise(F.lit(bool(mode_value))))


def one_zero_bool(c: Column) -> Column:
    """'1'/'true' -> true, '0'/'false' -> false, anything else -> null."""
    v = F.trim(F.lower(c.cast("string")))
    return (F.when(v.isin("1", "true"), F.lit(True))
            .when(v.isin("0", "false"), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))


def map_values(c: Column, mapping: dict) -> Column:
    """Replace listed values; unlisted values pass through unchanged."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(c == F.lit(k), F.lit(v)) if expr is None
                else expr.when(c == F.lit(k), F.lit(v)))
    return c if expr is None else expr.otherwise(c)


def all_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, preds) if preds else F.lit(True)


def not_in_keep_null(c: Column, values: list) -> Column:
    """pandas ``~isin``: rows whose value is null are kept (SQL NOT IN drops them)."""
    return ~F.coalesce(c.isin(*values), F.lit(False))
