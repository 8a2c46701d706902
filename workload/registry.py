"""Where queries and their oracles are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def keep(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return keep


def tidy(df: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round doubles, so that the order of a floating-point sum cannot show in a comparison."""
    cells = []
    for name, kind in df.dtypes:
        cell = F.col(f"`{name}`")
        if kind in ("double", "float"):
            cell = F.round(cell, special.get(name, digits))
        elif kind.startswith("array<string"):
            cell = F.concat_ws(",", cell)
        cells.append(cell.alias(name))
    return df.select(*cells)


def u(salt: str, key: str) -> str:
    """SQL of the library's reproducible uniform draw."""
    digits = f"substr(md5('{salt}|' || CAST({key} AS VARCHAR)), 1, 13)"
    return f"(CAST(('0x' || {digits})::BIGINT AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))"
