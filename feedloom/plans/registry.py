"""Registry of end-to-end queries: key -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the given
tables. Oracle SQL computes the same answer from the raw tables with DuckDB; a key
without SQL gets the driver's rows-only check (and a brute-force pytest instead).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key`` with its oracle SQL."""
    def deco(fn: Builder) -> Builder:
        if key in _QUERIES:
            raise ValueError(f"duplicate query key {key}")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql.strip()
        return fn
    return deco


def _load_all() -> None:
    from . import (  # noqa: F401
        q_catalog,
        q_chain,
        q_extract,
        q_fields,
        q_normalise,
        q_quality,
        q_query,
        q_stream,
        q_sync,
    )


def queries() -> dict[str, Builder]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_SQL)
