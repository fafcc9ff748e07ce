"""Where the query modules enter their queries and SQL."""

from __future__ import annotations

from filedrop.session import prepare

QUERIES = {}
ORACLES = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the SQL with the same columns."""

    def add(fn):
        def run(spark, sf_dir):
            return fn(prepare(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return add
