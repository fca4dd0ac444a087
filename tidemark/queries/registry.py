"""Registered queries: a Spark plan and, where SQL can say it, the same in SQL.

A query names its result columns once, with types; both sides are cast to
them. Days and timestamps leave as ISO text, because the open end of a
validity window (9999-12-31) does not fit nanosecond timestamps.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure

# column kind -> (Spark cast, SQL expression)
_KINDS = {
    "i": (lambda c: F.col(c).cast("int"), "CAST({c} AS INTEGER)"),
    "l": (lambda c: F.col(c).cast("bigint"), "CAST({c} AS BIGINT)"),
    "d": (lambda c: F.col(c).cast("double"), "CAST({c} AS DOUBLE)"),
    "s": (lambda c: F.col(c).cast("string"), "CAST({c} AS VARCHAR)"),
    "b": (lambda c: F.col(c).cast("boolean"), "CAST({c} AS BOOLEAN)"),
    "D": (lambda c: F.date_format(c, "yyyy-MM-dd"), "strftime(CAST({c} AS DATE), '%Y-%m-%d')"),
    "t": (
        lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
    ),
}


class Lake:
    """The tables below one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def __getattr__(self, table: str) -> DataFrame:
        if table.startswith("_"):
            raise AttributeError(table)
        return self.spark.read.parquet(self.path(table))


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    """A named subquery that registered SQL may build on."""
    CTES[name] = (sql, needs)


def _with(names: tuple[str, ...]) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for need in CTES[name][1]:
                visit(need)
            ordered.append(name)

    for n in names:
        visit(n)
    return "WITH " + ", ".join(f"{n} AS ({CTES[n][0]})" for n in ordered) + " " if ordered else ""


def query(name: str, columns: str, sql: str | None = None, needs: str = ""):
    """Register ``build(lake) -> DataFrame`` with result columns ``"name:kind ..."``."""
    cols = [c.rsplit(":", 1) for c in columns.split()]

    def register(build: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = build(Lake(spark, folder))
            return out.select(*[_KINDS[kind][0](c).alias(c) for c, kind in cols])

        text = None
        if sql is not None:
            casts = ", ".join(f"{_KINDS[kind][1].format(c=c)} AS {c}" for c, kind in cols)
            text = f"{_with(tuple(needs.split()))}SELECT {casts} FROM ({sql}) AS result"
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, run, text)
        return build

    return register
