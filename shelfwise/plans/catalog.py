"""Registry of queries and of the SQL each is checked against."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.plans.views import COMPUTED_ONCE, VIEW_SQL, Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _used(text: str) -> set[str]:
    return set(re.findall(r"\bv_\w+", text)) & VIEW_SQL.keys()


def with_views(sql: str) -> str:
    """Put the definitions of the views a statement uses in front of it."""
    needed: set[str] = set()
    todo = _used(sql)
    while todo:
        needed |= todo
        todo = set().union(*[_used(VIEW_SQL[name]) for name in todo]) - needed
    parts = [
        f"{name} AS {'MATERIALIZED ' if name in COMPUTED_ONCE else ''}({VIEW_SQL[name]})"
        for name in VIEW_SQL if name in needed
    ]
    body = sql.strip()
    if body.upper().startswith("WITH "):
        own = body[5:]
        return f"WITH {', '.join([*parts, own])}"
    return f"WITH {', '.join(parts)} {body}" if parts else body


def query(name: str, sql: str | None = None):
    """Register a function of ``Views`` under ``name``, with its SQL where there is one."""

    def register(build: Callable[[Views], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register
