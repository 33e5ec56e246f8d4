"""Named queries over the test tables, each with its SQL counterpart where there is one."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from docweave.plans.view_sql import VIEWS
from docweave.sources.views import Tables


@dataclass(frozen=True)
class Query:
    name: str
    covers: str  # rows of the operator inventory
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


QUERIES: dict[str, Query] = {}


def query(name: str, covers: str, sql: str | None = None):
    """Register a function from ``Tables`` to a DataFrame."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, covers, build, with_views(sql) if sql else None)
        return build

    return register


def with_views(sql: str) -> str:
    """Put the views a statement names in front of it as common table expressions."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name, text in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", body):
                visit(text)
                needed.append(name)

    visit(sql)
    ctes = [f"{name} AS ({VIEWS[name].strip()})" for name in needed]
    body = sql.strip()
    if not ctes:
        return body
    recursive = re.match(r"(?i)WITH\s+RECURSIVE\s+", body)
    plain = re.match(r"(?i)WITH\s+", body)
    head = "WITH RECURSIVE " if recursive else "WITH "
    if recursive or plain:
        rest = body[(recursive or plain).end():]
        return f"{head}{', '.join(ctes)}, {rest}"
    return f"{head}{', '.join(ctes)} {body}"
