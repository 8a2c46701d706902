"""Scoring a stream with the current champion."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession

from tidewatch.plans.lifecycle import champion
from tidewatch.plans.scoring import score, to_log_rows
from tidewatch.sources.tables import Workspace


def score_stream(model: PipelineModel, stream: DataFrame, threshold: float = 0.35) -> DataFrame:
    """A fitted pipeline is column expressions, so it applies to a stream as it is."""
    return score(model, stream, threshold)


def serve_with_champion(
    spark: SparkSession,
    ws: Workspace,
    model_name: str,
    created_at: Column,
    prediction_id: Column,
    threshold: float = 0.35,
    swapped: Callable[[int | None, int], None] | None = None,
    sink: Callable[[DataFrame, int], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function that scores and logs with the champion of the moment.

    The alias is read once per micro-batch, so a batch never mixes versions; the model is
    loaded again only when the alias has moved. ``sink`` takes the log rows of a batch, such
    as :func:`tidewatch.streaming.logsink.log_sink`, which puts them into the prediction log;
    without one, each batch is a folder of ``served``, replaced on replay.
    """
    held: dict = {"version": None, "model": None}

    def run(batch: DataFrame, batch_id: int) -> None:
        current = champion(spark, ws, model_name)
        if current is None:
            raise LookupError(f"no champion for {model_name}")
        version = current["version"]
        if version != held["version"]:
            held["model"] = PipelineModel.load(ws.model_path(model_name, version))
            if swapped:
                swapped(held["version"], version)
            held["version"] = version
        scored = score(held["model"], batch, threshold)
        rows = to_log_rows(scored, model_name, version, created_at, prediction_id)
        if sink:
            sink(rows, batch_id)
        else:
            rows.write.mode("overwrite").parquet(ws.path("served", f"batch_id={batch_id}"))

    return run
