"""Unbroken runs over time, put together from slices of the time axis.

A window over a whole key sorts all rows of that key in one task. Here time is cut into
slices that hold about the same number of rows; runs are counted inside (key, slice), and a
slice is summarised by one row: whether a run is broken in it, and how long the run is that
reaches its end. Summaries of neighbouring slices combine, so the run that enters a slice
follows from at most one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.operators.ordering import default_slices, with_slices


def _in_slices(df: DataFrame, by: Sequence[str], ts: str, slices: int | None) -> DataFrame:
    """Add ``_at`` (microseconds), ``_slice`` and ``_g``, a struct in which NULL keys are equal."""
    timed = df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    sliced = with_slices(timed, "_at", [], slices or default_slices(df))
    return sliced.withColumn("_g", F.struct(*by) if by else F.struct(F.lit(0).alias("all")))


def run_lengths(
    df: DataFrame, by: Sequence[str], ts: str, hit: Column, stop: Column, slices: int | None = None
) -> DataFrame:
    """Add ``run_length`` and ``run_since``: hits of the run up to a row, and the time of its first.

    A row where ``stop`` holds ends the run before it; rows with neither ``hit`` nor ``stop``
    leave it as it is. Rows of a key at one time count together.
    """
    marked = _in_slices(
        df.withColumn("_run_hit", hit.cast("int")).withColumn("_run_stop", stop.cast("int")), by, ts, slices
    )
    inside = ["_slice", "_g"]
    ordered = W.partitionBy(*inside).orderBy("_at")
    started = F.when(F.col("_run_hit") == 1, F.col("_at"))
    local = marked.withColumn("_run", F.sum("_run_stop").over(ordered)).select(
        "*",
        F.sum("_run_hit").over(W.partitionBy(*inside, "_run").orderBy("_at")).alias("_n"),
        F.min(started).over(W.partitionBy(*inside, "_run").orderBy("_at")).alias("_first"),
    )
    # One row per run of a slice, then one per slice: its stops and the run that is open at its end.
    runs = local.groupBy(*inside, "_run").agg(F.sum("_run_hit").alias("n"), F.min(started).alias("first"))
    ends = runs.groupBy(*inside).agg(
        (F.max("_run") > 0).cast("int").alias("broken"),
        F.max_by(F.struct("n", "first"), "_run").alias("open"),
    )
    along = W.partitionBy("_g").orderBy("_slice")
    epoch = ends.withColumn("epoch", F.sum("broken").over(along))
    carried = W.partitionBy("_g", "epoch").orderBy("_slice")
    leaving = epoch.select(
        *inside,
        F.struct(F.sum("open.n").over(carried).alias("n"), F.min("open.first").over(carried).alias("first")).alias("out"),
    )
    entering = leaving.select(*inside, F.lag("out").over(along).alias("_in"))
    first_run = F.col("_run") == 0
    since = F.when(first_run, F.least("_in.first", "_first")).otherwise(F.col("_first"))
    return local.join(entering, inside).select(
        *df.columns,
        (F.col("_n") + F.when(first_run, F.coalesce("_in.n", F.lit(0))).otherwise(0)).alias("run_length"),
        F.timestamp_micros(since).alias("run_since"),
    )


def previous_values(
    df: DataFrame, by: Sequence[str], ts: str, value: str, slices: int | None = None
) -> DataFrame:
    """Add ``previous``: the value of the key's sample before, NULL for its first.

    Samples of a key at one time are ordered by their value.
    """
    marked = _in_slices(df, by, ts, slices)
    inside = ["_slice", "_g"]
    local = marked.withColumn("_before", F.lag(value).over(W.partitionBy(*inside).orderBy("_at", value)))
    local = local.withColumn("_first", F.row_number().over(W.partitionBy(*inside).orderBy("_at", value)) == 1)
    last = marked.groupBy(*inside).agg(F.max_by(value, F.struct("_at", value)).alias("last"))
    entering = last.select(*inside, F.lag("last").over(W.partitionBy("_g").orderBy("_slice")).alias("_in"))
    return local.join(entering, inside).select(
        *df.columns, F.when(F.col("_first"), F.col("_in")).otherwise(F.col("_before")).alias("previous")
    )
