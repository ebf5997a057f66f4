"""Collects queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import BASE, FULL, with_clause

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _used(views: dict[str, str], sql: str) -> list[str]:
    words = set(sql.replace("(", " ").replace(")", " ").replace(",", " ").split())
    return [v for v in views if v in words]


def query(name: str, sql: str | None = None):
    """Register a query; views named in the SQL get their ``WITH`` prefix."""

    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            views = {**BASE, **FULL}
            used = _used(views, sql)
            prefix = with_clause(views, used) if used else ""
            if used and sql.startswith("WITH "):
                SQL[name] = f"{prefix}, {sql.removeprefix('WITH ')}"
            else:
                SQL[name] = f"{prefix} {sql}".strip()
        return fn

    return add
