"""Registration of queries and assembly of their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
CASES: dict[str, tuple[Query, str | None]] = {}
CTES: dict[str, str] = {}


def case(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in CASES:
            raise ValueError(f"query {name} registered twice")
        CASES[name] = (query, None if sql is None else with_ctes(sql))
        return query

    return register


def with_ctes(body: str) -> str:
    """Prefix the shared CTEs a query names, in order of need."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]})" for n in needed) + "\n" + body
