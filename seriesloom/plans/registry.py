"""Registered queries and, next to each, the SQL that states the same result.

SQL is composed from the common table expressions below: a name used in a query
pulls in its definition and those it depends on.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CTE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, folder) -> DataFrame function under a name."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = compose(sql)
        return fn

    return register


def cte(name: str, body: str) -> None:
    CTE[name] = body.strip()


def _used(text: str) -> set[str]:
    unquoted = re.sub(r"'[^']*'", "", text)
    return set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", unquoted)) & CTE.keys()


def compose(sql: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the definitions it needs, in order of definition."""
    needed, todo = set(), _used(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= _used(CTE[name]) - {name}
    parts = [f"{n} AS (\n{CTE[n]}\n)" for n in CTE if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + sql.strip()


def r(expr: str, digits: int = 6) -> str:
    """Rounded expression; adding zero turns a negative zero into zero."""
    return f"(round({expr}, {digits}) + 0.0)"


def cols(columns: dict[str, str], digits: int = 6) -> str:
    """Rounded and named expressions as a select list."""
    return ",\n  ".join(f'{r(e, digits)} AS "{n}"' for n, e in columns.items())
