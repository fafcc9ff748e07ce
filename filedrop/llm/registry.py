"""Where the operators enter their queries and SQL."""

from __future__ import annotations

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add
