"""Streams of predictions and labels: event time, de-duplication, joins and sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.predictionlog import most_recent
from tidewatch.streaming.state import use_keyed_state


def with_event_time(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Watermark on ``ts``; zone-less timestamps are cast first, as a watermark needs."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def unique_predictions(stream: DataFrame, delay: str) -> DataFrame:
    """First arrival of each prediction id; state is dropped once the watermark has passed."""
    return with_event_time(stream, "created_at", delay).dropDuplicatesWithinWatermark(
        ["prediction_id"]
    )


def join_labels(
    predictions: DataFrame, labels: DataFrame, delay: str, horizon: str, how: str = "leftOuter"
) -> DataFrame:
    """Predictions with the label that arrives within ``horizon``.

    The time bound lets both sides be evicted; unmatched predictions come out once the
    watermark passes. Labels of any age also go to the feedback table, from which
    ``attach_feedback`` repairs what this join could no longer see.
    """
    use_keyed_state(predictions.sparkSession)
    p = with_event_time(predictions, "created_at", delay).alias("p")
    f = with_event_time(labels, "feedback_at", delay).alias("f")
    condition = F.expr(
        "p.prediction_id = f.prediction_id AND f.feedback_at >= p.created_at "
        f"AND f.feedback_at <= p.created_at + INTERVAL {horizon}"
    )
    return p.join(f, condition, how).select("p.*", "f.actual", "f.feedback_at")


def write_batches(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", available_now: bool = True
) -> StreamingQuery:
    """Write each micro-batch to its own folder, overwritten if the batch is replayed.

    A batch that is run again after a lost executor or a restart replaces its own output,
    so the table holds every batch once.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return start(stream, sink, checkpoint, mode, available_now)


def start(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    available_now: bool = True,
) -> StreamingQuery:
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(sink).start()


def latest_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Final state of an update-mode table: the row of the highest batch for each key."""
    others = [c for c in updates.columns if c not in (*keys, "batch_id")]
    last = updates.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_id").alias("r"))
    return last.select(*keys, "r.*")


def window_after_each_batch(
    log: Callable[[], DataFrame], n: int, act: Callable[[DataFrame, int], None]
) -> Callable[[DataFrame, int], None]:
    """A batch function that hands the newest ``n`` rows of the log to ``act``.

    Streams have no window by count; the sink table has, by a top-n.
    """

    def run(_: DataFrame, batch_id: int) -> None:
        act(most_recent(log(), n), batch_id)

    return run


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows the watermark discarded, from the progress reports: late data is never silent."""
    return sum(
        int(state["numRowsDroppedByWatermark"])
        for progress in query.recentProgress
        for state in progress["stateOperators"]
    )
