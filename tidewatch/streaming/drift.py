"""Windowed drift of a stream against a fixed reference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import bucket_of, number_of
from tidewatch.operators.drift import psi_between_maps, quantile_edges
from tidewatch.operators.quantiles import value_counts


def reference_buckets(reference: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, edges, ref, t_ref): edges and bucket counts, one row per monitored column."""
    edges = quantile_edges(reference, columns, bins)
    counted = (
        value_counts(reference, columns)
        .join(F.broadcast(edges), "feature")
        .groupBy("feature", bucket_of("edges", "value", bins - 1).alias("bucket"))
        .agg(F.sum("n").alias("n"), F.first("edges").alias("edges"))
    )
    return counted.groupBy("feature").agg(
        F.first("edges").alias("edges"),
        F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("ref"),
        F.sum("n").alias("t_ref"),
    )


def written_buckets(reference: DataFrame, columns: Sequence[str], path: str, bins: int = 10) -> DataFrame:
    """:func:`reference_buckets`, fitted once: a stream would fit them again for every batch."""
    reference_buckets(reference, columns, bins).write.mode("overwrite").parquet(path)
    return reference.sparkSession.read.parquet(path)


def window_bucket_counts(
    stream: DataFrame, fitted: DataFrame, columns: Sequence[str], ts: str, width: str, bins: int = 10
) -> DataFrame:
    """Streaming counts per (window, feature, bucket); state is a few rows per window."""
    long = stream.select(
        F.col(ts), *[number_of(stream, c).alias(c) for c in columns]
    ).unpivot([ts], list(columns), "feature", "value")
    edges = F.broadcast(fitted.select("feature", "edges"))  # one row per column
    return (
        long.where("value IS NOT NULL")
        .join(edges, "feature")
        .groupBy(
            F.window(ts, width).alias("w"),
            "feature",
            bucket_of("edges", "value", bins - 1).alias("bucket"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "feature", "bucket", "n")
    )


def finish_windows(counts: DataFrame, fitted: DataFrame) -> DataFrame:
    """PSI per (window, feature) from bucket counts; run on the sink of the counts."""
    current = counts.groupBy("window_start", "feature").agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("cur"),  # <= bins
        F.sum("n").alias("t_cur"),
    )
    psi = psi_between_maps(F.col("ref"), F.col("t_ref"), F.col("cur"), F.col("t_cur"))
    return current.join(F.broadcast(fitted), "feature").select(
        "window_start", "feature", F.col("t_cur").alias("n_current"), psi.alias("psi")
    )
