"""Registry of named queries over the driver's tables, and their SQL oracles.

A registered query is ``fn(spark, sf_dir) -> DataFrame`` reading whole tables; its oracle is an
SQL string over the raw tables (``region nation customer supplier part orders lineitem events``)
that an independent engine can run.  Queries that have no SQL form register ``sql=None``.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco
