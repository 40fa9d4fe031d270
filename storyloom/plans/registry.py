"""Registry of the archive queries: name to (Spark callable, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a callable (spark, folder) under a name, with its SQL twin if there is one."""

    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep
