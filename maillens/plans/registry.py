"""Registry of named queries: Spark builder + optional DuckDB oracle SQL.

A query is a callable ``(spark, sf_dir) -> DataFrame`` over the given
tables (or tables Spark derives from them). Queries whose result can be
written in SQL carry the equivalent DuckDB statement; the others carry
``None`` and are checked by row count plus their own unit tests.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    doc: str


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn`` as query ``name`` with optional oracle ``sql``."""

    def wrap(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = Query(name, fn, sql, (fn.__doc__ or "").strip())
        return fn

    return wrap
