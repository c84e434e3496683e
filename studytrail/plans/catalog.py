"""All registered queries."""

from __future__ import annotations

from functools import cache

from studytrail.plans import (
    cell_queries,
    collection_queries,
    report_queries,
    session_queries,
    stream_queries,
)
from studytrail.plans.registry import Registry


@cache
def catalog() -> Registry:
    reg = Registry()
    for module in (session_queries, report_queries, collection_queries, cell_queries, stream_queries):
        module.register(reg)
    return reg
