"""All registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from tidemark.checks import cleaning, learning, market, portfolio, storage

MODULES = (market, cleaning, portfolio, learning, storage)


def queries() -> dict[str, Callable]:
    return {name: q for module in MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: s for module in MODULES for name, s in module.SQL.items()}
