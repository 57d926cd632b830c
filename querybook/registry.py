"""Named queries over the test tables, each with its SQL twin where one exists."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reviewmill.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
COMMON_TABLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its SQL twin."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return fn

    return add


def common_table(name: str, sql: str) -> None:
    """Declare a named subquery that SQL twins may refer to."""
    COMMON_TABLES[name] = sql


def _mentioned(sql: str) -> list[str]:
    return [name for name in COMMON_TABLES if re.search(rf"\b{name}\b", sql)]


def with_tables(sql: str) -> str:
    """Prefix the common tables a statement needs, in order of declaration."""
    needed: set[str] = set()
    waiting = _mentioned(sql)
    while waiting:
        name = waiting.pop()
        if name not in needed:
            needed.add(name)
            waiting.extend(_mentioned(COMMON_TABLES[name]))
    if not needed:
        return sql
    parts = [f"{name} AS ({COMMON_TABLES[name]})" for name in COMMON_TABLES if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + sql


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
