"""Registry of named queries: one Spark callable per operator key and, where
an exact SQL equivalent exists, the DuckDB oracle text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    key: str
    fn: QueryFn
    sql: str | None
    section: str


_REGISTRY: dict[str, Query] = {}


def register(key: str, section: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in _REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        _REGISTRY[key] = Query(key, fn, sql, section)
        return fn
    return deco


def _load_all() -> None:
    # Importing the plan modules fills the registry.
    from wellspark.plans import (  # noqa: F401
        q_clean, q_ml, q_models, q_profile, q_retrieval, q_sources, q_stream, q_text)


def all_queries() -> dict[str, Query]:
    _load_all()
    return dict(_REGISTRY)
