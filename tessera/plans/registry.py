"""Registry of named queries: ``name -> (spark_fn, oracle_sql or None)``.

Each Spark function takes ``(spark, sf_dir)`` and returns a lazy DataFrame
over the whole input tables; the SQL text runs in DuckDB over the same
parquet files (views named after the tables) and must produce the same
column names and values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLE[name] = oracle.strip()
        return fn
    return deco


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def _load() -> None:
    # Importing the modules registers their queries.
    from tessera.plans import (q_knowledge, q_memory, q_scalar, q_search,  # noqa: F401
                               q_stream, q_text, q_tools)
