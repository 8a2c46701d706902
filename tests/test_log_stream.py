"""Streams that end in the log and in the labeled table."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import decisions, predictionlog
from tidewatch.plans import monitoring
from tidewatch.sources.tables import SurplusCells, Workspace, read_csv, split_csv
from tidewatch.streaming import events, logsink, state

T0 = datetime(2026, 1, 1, 22)
LOG = predictionlog.LOG_SCHEMA


def row(i, at=None, score=0.5):
    return (f"p{i}", at or T0 + timedelta(minutes=10 * i), "m", "1", "{}", score, 1)


def ids(df):
    return sorted(r["prediction_id"] for r in df.select("prediction_id").collect())


def test_a_batch_replaces_itself_even_on_other_days(spark, tmp_path):
    ws = Workspace(str(tmp_path))
    sink = logsink.log_sink(ws, "api")
    batch = spark.createDataFrame([row(i) for i in range(20)] + [row(3), row(4)], LOG)
    sink(batch, 0)
    assert ids(ws.predictions(spark)) == sorted(f"p{i}" for i in range(20))
    assert ws.predictions(spark).select("created_date").distinct().count() == 2
    # The same batch again, stamped two days later: its first attempt is gone.
    sink(batch.withColumn("created_at", F.col("created_at") + F.expr("INTERVAL 2 DAYS")), 0)
    assert ids(ws.predictions(spark)) == sorted(f"p{i}" for i in range(20))
    assert ws.predictions(spark).agg(F.min("created_date")).first()[0].day == 3
    entry = ws.log_batches(spark).collect()
    assert [(r["source"], r["batch_id"], r["n_received"], r["n_logged"]) for r in entry] == [("api", 0, 22, 20)]


def test_ids_of_other_batches_and_loads_are_left_out(spark, tmp_path):
    ws = Workspace(str(tmp_path))
    ws.append_predictions(spark.createDataFrame([row(1), row(2)], LOG))
    sink = logsink.log_sink(ws, "api")
    sink(spark.createDataFrame([row(2), row(3)], LOG), 0)
    sink(spark.createDataFrame([row(3), row(4, None), row(1)], LOG), 1)
    sink(spark.createDataFrame([], LOG), 2)
    assert ids(ws.predictions(spark)) == ["p1", "p2", "p3", "p4"]
    assert {r["batch_id"]: r["n_logged"] for r in ws.log_batches(spark).collect()} == {0: 1, 1: 1, 2: 0}
    with pytest.raises(ValueError):
        ws.replace_batch(spark.createDataFrame([row(9)], LOG), "predictions", "../x")


def test_the_stream_feeds_the_monitored_window(spark, tmp_path):
    """A stream with no name of its own, replayed from a lost checkpoint, is seen once by the monitor."""
    ws = Workspace(str(tmp_path / "ws"))
    source = str(tmp_path / "in")
    for part in range(3):
        spark.createDataFrame([row(i) for i in range(part * 5, part * 5 + 5)], LOG).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
    for attempt in range(2):
        events.start(stream, logsink.log_sink(ws), f"{tmp_path}/checkpoint-{attempt}").awaitTermination()
    window = monitoring.recent_window(spark, ws, "m", T0 + timedelta(days=1))
    assert ids(window) == sorted(f"p{i}" for i in range(15))
    ledger = ws.log_batches(spark).collect()
    assert len(ledger) == 6 and sum(r["n_logged"] for r in ledger) == 15


def test_labels_are_corrected_and_only_touched_days_rewritten(spark, tmp_path):
    ws = Workspace(str(tmp_path))
    log = spark.createDataFrame([row(i, T0 + timedelta(days=i)) for i in range(4)], LOG)
    joined = log.withColumn("actual", F.lit(None).cast("int")).withColumn("feedback_at", F.lit(None).cast("timestamp"))
    sink = logsink.labeled_sink(ws, "labels")
    sink(joined, 0)
    assert ws.labeled(spark).where("actual IS NULL").count() == 4

    def files():
        return {d: sorted(os.listdir(tmp_path / "labeled" / d)) for d in os.listdir(tmp_path / "labeled") if "=" in d}

    before = files()
    at = lambda h: T0 + timedelta(days=1, hours=h)
    first = log.where("prediction_id = 'p1'")
    labels = [first.withColumn("actual", F.lit(v)).withColumn("feedback_at", F.lit(at(h))) for v, h in ((1, 2), (0, 5), (1, 3))]
    sink(labels[0].unionByName(labels[1]), 1)
    sink(labels[2], 2)  # an older label that arrives later
    assert [(r["actual"], r["feedback_at"]) for r in ws.labeled(spark).where("prediction_id = 'p1'").collect()] == [(0, at(5))]
    changed = {d for d in before if files()[d] != before[d]}
    assert changed == {"created_date=2026-01-02"}
    # A label of another age is found in the feedback; one that the join has seen is not taken again.
    feedback = spark.createDataFrame([("p3", 1, T0 + timedelta(days=9)), ("p1", 0, at(5)), ("gone", 1, T0)], predictionlog.FEEDBACK_SCHEMA)
    logsink.repair_labels(ws, log, feedback, "'1' DAY", "repair")
    want = predictionlog.attach_feedback(log, feedback)
    pick = lambda df: sorted((r["prediction_id"], r["actual"], r["feedback_at"]) for r in df.collect() if r["actual"] is not None)
    assert pick(ws.labeled(spark)) == pick(want) and ws.labeled(spark).count() == 4


def test_stream_debounce_honours_evaluated_and_allowed(spark, tmp_path):
    schema = "model_name string, cycle_ts timestamp, triggered boolean, evaluated boolean, allowed boolean"
    marks = "TT-TnTTFTTT-T"  # - not evaluated, n not allowed
    rows = [
        (m, T0 + timedelta(minutes=i), c in "Tn-", c != "-", c != "n")
        for m in ("a", "b") for i, c in enumerate(marks if m == "a" else marks[::-1])
    ]
    table = spark.createDataFrame(rows, schema)
    rows.sort(key=lambda r: r[1])
    for i in range(0, len(rows), 5):
        spark.createDataFrame(rows[i : i + 5], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    fired = state.debounce_stream(stream, 3, evaluated="evaluated", allow="allowed")
    events.write_batches(fired, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").drop("batch_id")
    want = decisions.debounce(table, 3, evaluated="evaluated", allow="allowed").select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.where("fire").count() > 0


def test_csv_rows_with_surplus_cells_are_reported(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write('a,b,c\n1,2,3\n4,"x, ""y""",6\n7,8\n9,10,11,12\n-NaN,#N/A N/A,none\n13,14,15,\n')
    good, bad = split_csv(spark, path)
    assert sorted(tuple(r) for r in good.fillna("~").collect()) == [("1", "2", "3"), ("4", 'x, "y"', "6"), ("7", "8", "~"), ("~", "~", "none")]
    assert sorted(tuple(r) for r in bad.collect()) == [("13,14,15,", 4), ("9,10,11,12", 4)]
    with pytest.raises(SurplusCells):
        read_csv(spark, path)
