"""Queries of this subpackage: builders and, where SQL can express them, DuckDB twins."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
