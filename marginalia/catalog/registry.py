"""Named queries, each with its output columns and, where SQL can say it, a check statement."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sqlviews import VIEWS

TYPES = {"l": ("bigint", "BIGINT"), "s": ("string", "VARCHAR"), "d": ("double", "DOUBLE"), "b": ("boolean", "BOOLEAN")}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    columns: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        out = []
        for name, kind in self.columns:
            c = F.col(name).cast(TYPES[kind][0])
            out.append((F.round(c, 6) if kind == "d" else c).alias(name))
        return self.build(spark, folder).select(*out)

    def check(self) -> str | None:
        if self.sql is None:
            return None
        out = []
        for name, kind in self.columns:
            c = f"CAST({name} AS {TYPES[kind][1]})"
            out.append(f"round({c}, 6) AS {name}" if kind == "d" else f"{c} AS {name}")
        return _with_views(self.sql, ", ".join(out))


QUERIES: dict[str, Query] = {}


def query(name: str, columns: str, sql: str | None = None):
    """Register ``build(spark, folder)`` under ``name``; ``columns`` reads ``name:kind …``."""
    pairs = tuple(tuple(part.split(":")) for part in columns.split())

    def add(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, pairs, sql)
        return build

    return add


def _needed(sql: str) -> list[str]:
    order: list[str] = []

    def visit(text: str) -> None:
        for view, body in VIEWS.items():
            if view not in order and re.search(rf"\b{view}\b", text):
                visit(body)
                if view not in order:
                    order.append(view)

    visit(sql)
    return order


def _with_views(sql: str, columns: str) -> str:
    views = [f"{v} AS MATERIALIZED ({VIEWS[v]})" for v in _needed(sql)]
    views.append(f"result_rows AS ({sql})")
    return f"WITH RECURSIVE {', '.join(views)} SELECT {columns} FROM result_rows"
