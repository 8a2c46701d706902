"""Streams keep their state in a store on disk, of which little is written and called for."""

from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from tidewatch.operators import decisions, predictionlog
from tidewatch.sources.tables import LOG_COLUMNS
from tidewatch.streaming import events, state
from workload import streams

T0 = datetime(2026, 1, 1)


def test_the_state_of_a_label_join_is_on_disk(spark, tmp_path):
    kinds = "prediction_id string, created_at timestamp", "prediction_id string, actual int, feedback_at timestamp"
    held = {key: spark.conf.get(key, None) for key in state.SETTINGS}
    for key in held:
        spark.conf.unset(key)  # as in a session that has run no other stream
    try:
        spark.createDataFrame([(f"p{i}", T0 + timedelta(minutes=i)) for i in range(30)], kinds[0]).write.parquet(f"{tmp_path}/p")
        spark.createDataFrame([(f"p{i}", 1, T0 + timedelta(hours=i)) for i in range(30)], kinds[1]).write.parquet(f"{tmp_path}/f")
        p, f = (spark.readStream.schema(k).parquet(f"{tmp_path}/{n}") for k, n in zip(kinds, "pf", strict=True))
        joined = events.join_labels(p, f, "1 hour", "'2' HOUR", "inner")
        run = events.write_batches(joined, f"{tmp_path}/out", f"{tmp_path}/cp")
        run.awaitTermination()
        metrics = run.lastProgress["stateOperators"][0]["customMetrics"]
        assert any(name.startswith("rocksdb") for name in metrics)
        found = spark.read.parquet(f"{tmp_path}/out").select("prediction_id").collect()
        assert sorted(r[0] for r in found) == ["p0", "p1", "p2"]
    finally:
        for key, value in held.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_many_models_share_a_call_and_their_runs_stay_apart(spark, tmp_path, monkeypatch):
    schema = "model_name string, cycle_ts timestamp, triggered boolean"
    rows = [
        (None if m == 7 else f"m{m}", T0 + timedelta(days=d), (m * 31 + d * (m % 5 + 1)) % 7 < 4)
        for d in range(12) for m in range(3000)
    ]
    table = spark.createDataFrame(pd.DataFrame(rows, columns=["model_name", "cycle_ts", "triggered"]), schema).persist()
    for part in range(3):
        days = F.dayofmonth("cycle_ts").between(4 * part + 1, 4 * part + 4)
        table.where(days).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        run = events.write_batches(state.debounce_stream(stream, 2), f"{tmp_path}/out", f"{tmp_path}/cp")
        run.awaitTermination()
    assert run.lastProgress["stateOperators"][0]["numRowsTotal"] < 3000  # values, not models
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch_id")
    want = decisions.debounce(table, 2).select(*got.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.where("fire").count() > 0 and got.where("model_name IS NULL").count() == 12


def test_the_labeled_log_holds_the_columns_of_the_log_in_its_state(spark, tmp_path, monkeypatch):
    kinds = ["purchase", "error", "view", "signup"]
    rows = [(i, T0.replace(year=2024) + timedelta(hours=9 * i), i, kinds[i % 4], 5.0 * i, f'{{"k": {i * 7 % 100}}}') for i in range(40)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/events.parquet")
    seen = []
    join = events.join_labels

    def watched(predictions, labels, *args):
        seen.append(predictions.columns)
        return join(predictions, labels, *args)

    monkeypatch.setattr(streams.events, "join_labels", watched)
    found = streams.stream_labeled_log(spark, str(tmp_path))
    assert seen[0] == LOG_COLUMNS and spark.conf.get(state.PROVIDER) == state.ROCKSDB
    log, feedback = streams.frames(spark, str(tmp_path), "prediction_log", "feedback")
    want = predictionlog.attach_feedback(log, feedback).select(
        "prediction_id", "model_version", "churn_prediction", F.coalesce("actual", F.lit(-1)).alias("actual"),
        "feedback_at", F.to_date("created_at").alias("created_date"),
    )
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and found.count() == 40
