"""Streams that end in the tables of the log: predictions, and the labels they get later.

A micro-batch is a folder within each day it touches, named after the stream and the batch.
Running it again removes those folders first, whatever days they are in, so a batch is in
the table once however often it is tried. The ledger has a row for each batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators.predictionlog import LOG_SCHEMA, first_of_each_id, latest_feedback
from tidewatch.sources.tables import LABELED_SCHEMA, Workspace

QUERY_ID = "sql.streaming.queryId"  # a job property that the engine sets for every micro-batch


def _name(spark: SparkSession, source: str | None, batch_id: int) -> str:
    """Batches of a stream that starts from a new checkpoint are not those of the old one."""
    return f"{source or spark.sparkContext.getLocalProperty(QUERY_ID) or 'stream'}-{batch_id}"


def _log_cells() -> list[Column]:
    """The columns of the log in its types."""
    return [F.col(name).cast(kind).alias(name) for name, kind in (c.split() for c in LOG_SCHEMA.split(", "))]


def log_sink(
    ws: Workspace, source: str | None = None, days_back: int = 1
) -> Callable[[DataFrame, int], None]:
    """A batch function that puts prediction rows into the log, each id once.

    Of an id that a batch repeats, the earliest row is taken. Ids that other batches or loads
    have put into the log are left out; they are looked for ``days_back`` days around those of
    the batch, which bounds what is read and must cover the time within which rows are sent
    again. ``source`` names the stream; by default it is the query's own id.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = _name(spark, source, batch_id)
        rows = batch.select(*_log_cells()).persist()
        try:
            day = F.to_date("created_at")
            facts = rows.agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("first"), F.max(day).alias("last")).first()
            log = ws.dated(spark, "predictions", LOG_SCHEMA).where(F.col("batch") != name)
            if facts["first"] is not None:
                near = F.col("created_date").between(
                    F.date_sub(F.lit(facts["first"]), days_back), F.date_add(F.lit(facts["last"]), days_back)
                )
                log = log.where(near | F.col("created_date").isNull())
            fresh = first_of_each_id(rows).join(log.select("prediction_id"), "prediction_id", "left_anti")
            ws.replace_batch(fresh, "predictions", name)
        finally:
            rows.unpersist()
        logged = ws.dated(spark, "predictions", LOG_SCHEMA).where(F.col("batch") == name).count()
        entry = spark.range(1).select(
            F.lit(source or "").alias("source"), F.lit(batch_id).cast("long").alias("batch_id"),
            F.lit(facts["n"]).cast("long").alias("n_received"), F.lit(logged).cast("long").alias("n_logged"),
            F.lit(facts["first"]).cast("date").alias("first_day"), F.lit(facts["last"]).cast("date").alias("last_day"),
            F.current_timestamp().alias("written_at"),
        )
        entry.write.mode("overwrite").parquet(ws.path("log_batches", f"batch={name}"))

    return run


def _put_changes(ws: Workspace, rows: DataFrame, name: str) -> None:
    """Store changes of labels and bring the days they touch up to date."""
    spark = rows.sparkSession
    changes = rows.select(*_log_cells(), F.col("actual").cast("int"), F.col("feedback_at").cast("timestamp"))
    ws.replace_batch(changes, "label_changes", name)
    stored = ws.dated(spark, "label_changes", LABELED_SCHEMA).where(F.col("batch") == name)
    days = [r["created_date"] for r in stored.select("created_date").distinct().collect()]  # one row a day
    ws.refresh_days(spark, [d for d in days if d is not None])


def labeled_sink(
    ws: Workspace, source: str | None = None, keep: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """A batch function for the output of ``join_labels``, unmatched predictions included.

    A prediction that gets a second label has a second row; the table holds the last label.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = batch if keep is None else batch.where(keep)
        _put_changes(ws, rows, _name(batch.sparkSession, source, batch_id))

    return run


def repair_labels(
    ws: Workspace, log: DataFrame, feedback: DataFrame, horizon: str, batch: str, oldest: Column | None = None
) -> None:
    """Put labels into ``labeled`` that came too late (or too early) for the stream's join.

    ``horizon`` is that of the join. Only predictions since ``oldest`` are looked at, all
    unless it is given; only the days of predictions whose label changes are rewritten.
    """
    rows = log if oldest is None else log.where(F.col("created_at") >= oldest)
    paired = rows.join(latest_feedback(feedback), "prediction_id")
    seen = F.expr(f"feedback_at >= created_at AND feedback_at <= created_at + INTERVAL {horizon}")
    _put_changes(ws, paired.where(~F.coalesce(seen, F.lit(False))), batch)
