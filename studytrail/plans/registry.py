"""Named queries with their SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from studytrail.plans.fixtures import FIXTURE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def ctes(*names: str, **more: str) -> str:
    """``with`` clause of the named fixtures and further queries."""
    parts = [f"{n} as ({FIXTURE_SQL[n]})" for n in names] + [f"{n} as ({q})" for n, q in more.items()]
    return "with " + ",\n ".join(parts) + "\n "


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, query: Query, sql: str | None = None) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} registered twice")
        self.queries[name] = query
        if sql is not None:
            self.sql[name] = sql
