"""Streams give what the batch operators give."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidewatch.operators import predictionlog
from tidewatch.streaming import events, state

T0 = datetime(2026, 1, 1)
LOG = "prediction_id string, created_at timestamp, score double"
LABELS = "prediction_id string, actual int, feedback_at timestamp"


def files(spark, rows, schema, path, parts=3):
    """Write rows as several files in time order, so the stream reads several batches."""
    step = -(-len(rows) // parts)
    for i in range(0, len(rows), step):
        spark.createDataFrame(rows[i : i + step], schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, schema, path):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_repeated_predictions_are_kept_once_across_batches(spark, tmp_path):
    rows = [(f"p{i % 20}", T0 + timedelta(minutes=i % 20), 0.5) for i in range(60)]
    files(spark, rows, LOG, f"{tmp_path}/in")
    kept = events.unique_predictions(stream(spark, LOG, f"{tmp_path}/in"), "1 day")
    query = events.write_batches(kept, f"{tmp_path}/out", f"{tmp_path}/cp")
    query.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 20 and out.select("prediction_id").distinct().count() == 20
    assert events.rows_dropped_late(query) == 0


def test_outer_label_join_equals_the_batch_join_once_the_watermark_has_passed(spark, tmp_path):
    far = T0 + timedelta(days=400)
    predictions = [(f"p{i}", T0 + timedelta(minutes=i), i / 40) for i in range(40)] + [("end", far, 0.0)]
    labels = [(f"p{i}", i % 2, T0 + timedelta(minutes=i + 30)) for i in range(0, 40, 3)] + [("end2", 0, far)]
    files(spark, predictions, LOG, f"{tmp_path}/p", 2)
    files(spark, labels, LABELS, f"{tmp_path}/f", 2)
    joined = events.join_labels(stream(spark, LOG, f"{tmp_path}/p"), stream(spark, LABELS, f"{tmp_path}/f"), "1 day", "'1' DAY")
    events.write_batches(joined, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").where("prediction_id <> 'end'")
    want = predictionlog.attach_feedback(spark.createDataFrame(predictions[:-1], LOG), spark.createDataFrame(labels[:-1], LABELS))
    rows = lambda df: sorted((r["prediction_id"], r["actual"] if r["actual"] is not None else -1) for r in df.collect())
    assert rows(got) == rows(want)


def test_debounce_state_survives_batches(spark, tmp_path):
    schema = "model_name string, cycle_ts timestamp, triggered boolean"
    pattern = "TFTTTTF"
    rows = [("m", T0 + timedelta(minutes=i), c == "T") for i, c in enumerate(pattern)]
    files(spark, rows, schema, f"{tmp_path}/in", len(rows))
    fired = state.debounce_stream(stream(spark, schema, f"{tmp_path}/in"), 2)
    events.write_batches(fired, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").orderBy("cycle_ts").collect()
    assert [i for i, r in enumerate(got) if r["fire"]] == [3, 5]


def test_newest_window_after_each_batch(spark, tmp_path):
    rows = [(f"p{i}", T0 + timedelta(minutes=i), 0.5) for i in range(30)]
    files(spark, rows, LOG, f"{tmp_path}/in")
    seen = []
    log_path = f"{tmp_path}/log"
    after = events.window_after_each_batch(
        lambda: spark.read.parquet(log_path), 5, lambda window, _: seen.append([r["prediction_id"] for r in window.collect()])
    )

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
        after(batch, batch_id)

    events.start(stream(spark, LOG, f"{tmp_path}/in"), sink, f"{tmp_path}/cp").awaitTermination()
    assert len(seen) == 3 and seen[-1] == [f"p{i}" for i in range(25, 30)]


def test_replayed_batch_replaces_its_own_rows(spark, tmp_path):
    rows = [(f"p{i}", T0, 0.5) for i in range(6)]
    files(spark, rows, LOG, f"{tmp_path}/in", 1)
    for attempt in range(2):  # a lost checkpoint replays batch 0
        events.write_batches(stream(spark, LOG, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/cp{attempt}").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 6
