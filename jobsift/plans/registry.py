"""Registry of queries and their SQL, shared by the catalog modules."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from jobsift.plans import fixtures as fx
from jobsift.plans import sqltext as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

P = fx.POSTINGS_SQL
E = fx.EVENTS_SQL
DOCS = fx.docs_sql()
DOC_BLOB = S.blob("description", "tech_stack")


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its DuckDB SQL (None: no SQL form)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _p(spark, d):
    return fx.postings_view(spark, d)


def _e(spark, d):
    return fx.event_postings_view(spark, d)


def _d(spark, d):
    return fx.doc_postings_view(spark, d)
