"""DuckDB oracle and an order-insensitive result comparison."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

from wellspark.sources.tables import TABLE_NAMES

ROUND_FLOATS = True  # the exact-equality audit turns this off


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLE_NAMES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return (round(v, 6) + 0.0) if ROUND_FLOATS else v + 0.0
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0)
                                           if not isinstance(x, tuple) else (False, "t", str(x))
                                           for x in r))


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, rel=1e-6):
    """Returns a list of problems (empty when equal)."""
    problems = []
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return [f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"]
    if len(spark_pdf) != len(duck_pdf):
        return [f"row count {len(spark_pdf)} vs {len(duck_pdf)}"]
    a, b = rows(spark_pdf), rows(duck_pdf)
    for i, (ra, rb) in enumerate(zip(a, b)):
        for j, (x, y) in enumerate(zip(ra, rb)):
            if isinstance(x, float) and isinstance(y, (float, int)) or isinstance(y, float) and isinstance(x, (int, float)):
                if x is None or y is None or not math.isclose(x, y, rel_tol=rel, abs_tol=1e-6 if rel else 0.0):
                    problems.append(f"row {i} col {sorted(spark_pdf.columns)[j]}: {x!r} vs {y!r}")
            elif x != y:
                problems.append(f"row {i} col {sorted(spark_pdf.columns)[j]}: {x!r} vs {y!r}")
            if len(problems) > 5:
                return problems
    return problems
