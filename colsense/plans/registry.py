"""All registered queries of the library and the same in SQL; importing a module of plans registers its queries."""

from __future__ import annotations

from . import building, columns, evaluation, exchange, learning, semantics, texts  # noqa: F401
from .base import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
