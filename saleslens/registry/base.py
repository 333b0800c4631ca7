"""Registration of queries and of their check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import Tables
from .views_sql import VIEWS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables``; ``sql`` may name the views of ``views_sql``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = with_views(sql)
        return fn

    return add


def with_views(sql: str) -> str:
    """Put the used views, in dependency order, in front of a query."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    body = sql.strip()
    views = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in needed)
    if re.match(r"WITH\s+RECURSIVE\b", body, re.I):
        return f"WITH RECURSIVE {views},\n" + re.sub(r"^WITH\s+RECURSIVE\s+", "", body, flags=re.I)
    if re.match(r"WITH\b", body, re.I):
        return f"WITH {views},\n" + re.sub(r"^WITH\s+", "", body, flags=re.I)
    return f"WITH {views}\n{body}"
