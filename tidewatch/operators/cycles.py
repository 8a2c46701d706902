"""Monitoring reports as rows: JSON payload, latest report per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cycle_payload(columns: Sequence[str]) -> Column:
    """Columns as JSON text with sorted keys; NULLs are written.

    JSON has no NaN or infinity, so columns should be passed through
    :func:`without_infinities` first where they can occur.
    """
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def without_infinities(df: DataFrame) -> DataFrame:
    """NaN and infinite doubles to NULL in every floating column."""
    cells = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("double", "float"):
            fine = ~F.isnan(column) & (F.abs(column) < F.lit(float("inf")))
            column = F.when(fine, column).alias(name)
        cells.append(column)
    return df.select(*cells)


def latest_cycle(reports: DataFrame, ts: str = "cycle_ts", by: str = "model_name") -> DataFrame:
    """The newest report row of each model, by partial aggregation."""
    others = [c for c in reports.columns if c != by]
    last = reports.groupBy(by).agg(F.max_by(F.struct(*others), F.col(ts)).alias("r"))
    return last.select(by, "r.*")
