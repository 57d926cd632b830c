"""Columns that must not be evaluated twice, and tables of literals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(table: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is evaluated exactly once per row.

    Filters are pushed below a plain projection by repeating its expressions,
    which would parse a JSON line again for every condition on it. They cannot
    pass the one-element ``explode`` used here.
    """
    return table.select("*", F.explode(F.array(value)).alias(name))


def literal_rows(table: DataFrame, **columns: tuple) -> DataFrame:
    """A small table of literals in the session of ``table``, made without a Python job."""
    names, rows = list(columns), zip(*columns.values())
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return table.sparkSession.range(1).select(F.inline(F.array(*structs)))
