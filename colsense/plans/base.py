"""The one list of registered queries and of the same in SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add
