"""Runs, cuts and trailing ranges against plain loops."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import decisions, predictionlog, runs, sampling, timeseries
from tidewatch.operators.selection import newest

T0 = datetime(2026, 1, 1)


def plain_runs(rows):
    """(key, minute) -> (hits of the run, minute of its first hit), peers of a minute together."""
    out, state = {}, {}
    for key, minute in sorted({(r[0] or "", r[1]) for r in rows}):
        here = [r for r in rows if (r[0] or "") == key and r[1] == minute]
        n, first = state.get(key, (0, None))
        if any(r[3] for r in here):
            n, first = 0, None
        hits = sum(r[2] for r in here)
        n, first = n + hits, first if first is not None or not hits else minute
        state[key] = out[key, minute] = (n, first)
    return out


@pytest.mark.parametrize("slices", [2, 16])
def test_runs_across_slices(spark, slices):
    rnd = random.Random(slices)
    rows = []
    for minute in range(300):  # one key has most rows, two are rare, one is missing
        for key, share in (("hot", 1.0), ("rare", 0.1), (None, 0.3), ("all", 0.5)):
            if rnd.random() < share:
                kind = "hit" if key == "all" else rnd.choices(["hit", "stop", "none"], [80, 5, 15])[0]
                rows.append((key, minute, int(kind == "hit"), int(kind == "stop")))
    rows += [("rare", 400, 1, 0)] * 3
    df = spark.createDataFrame([(k, T0 + timedelta(minutes=m), m, h, s) for k, m, h, s in rows], "k string, t timestamp, m int, h int, s int")
    got = runs.run_lengths(df, ["k"], "t", F.col("h") == 1, F.col("s") == 1, slices)
    assert got.columns == [*df.columns, "run_length", "run_since"]
    want = plain_runs(rows)
    for r in got.collect():
        n, first = want[r["k"] or "", r["m"]]
        assert r["run_length"] == n
        if r["h"]:
            assert r["run_since"] == T0 + timedelta(minutes=first)
    assert got.count() == len(rows)


def windows_of(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [line for line in plan.split("\n") if "windowspecdefinition" in line]


def test_no_window_over_a_whole_key(spark):
    cycles = spark.createDataFrame([("m", T0, True)], "model_name string, cycle_ts timestamp, triggered boolean")
    samples = spark.createDataFrame([("error_ratio", T0, 0.5)], "metric string, ts timestamp, value double")
    for df, key in ((decisions.debounce(cycles), "model_name"), (timeseries.alert_states(samples), "alert")):
        found = windows_of(df)
        assert found
        for line in found:  # by slice, or over one summary row per slice
            assert "_slice" in line and f"windowspecdefinition({key}#" not in line


def test_counter_increase_with_resets(spark):
    values = [5, 7, 7, 12, 3, 4, 0, 9]  # 2 + 0 + 5, then 3 again from the start, 1, 0, 9
    rows = [("a", T0 + timedelta(minutes=10 * i), v) for i, v in enumerate(values)] + [("b", T0, 4)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, v int")
    got = {(r["k"], r["window_start"]): r["increase"] for r in timeseries.counter_increase(df, "ts", "v", "30 minutes", by=["k"]).collect()}
    half = timedelta(minutes=30)
    assert got == {("a", T0): 2.0, ("a", T0 + half): 9.0, ("a", T0 + 2 * half): 9.0, ("b", T0): 0.0}


def test_presence_fills_the_gaps(spark):
    df = spark.createDataFrame([("a", T0 + timedelta(minutes=m)) for m in (0, 1, 65, 200)] + [("b", T0 + timedelta(minutes=130))], "k string, ts timestamp")
    got = timeseries.presence(df, "ts", "1 hour", "up", ["k"]).orderBy("k", "ts").collect()
    assert [(r["k"], r["value"]) for r in got] == [("a", 1.0), ("a", 1.0), ("a", 0.0), ("a", 1.0), ("b", 1.0), ("b", 0.0)]
    assert {r["metric"] for r in got} == {"up"}


@pytest.mark.parametrize("n", [0, 1, 7, 40, 41, 90, 120, 500])
def test_newest_rows_by_counting(spark, n):
    rnd = random.Random(1)
    rows = [(f"id-{rnd.randrange(10**9):09d}-{'x' * (i % 9)}", T0 + timedelta(days=i % 4, seconds=i % 3)) for i in range(100)]
    rows += [(f"same-{i:03d}", T0 + timedelta(days=9)) for i in range(30)]  # one instant
    rows += [("twice", T0 + timedelta(days=10))] * 10 + [(None, T0 + timedelta(days=2)), ("no time", None)]
    df = spark.createDataFrame(rows, "prediction_id string, created_at timestamp").repartition(3)
    lowest = datetime(1, 1, 1)
    want = sorted(rows, key=lambda r: (r[1] or lowest, r[0] or ""))[len(rows) - min(n, len(rows)) :]
    got = newest(df, n).collect()
    assert sorted((r[1] or lowest, r[0] or "") for r in got) == [(t or lowest, k or "") for k, t in want]


def test_selection_needs_no_top_n(spark, tmp_path):
    rows = [(f"p{i}", T0 + timedelta(hours=i)) for i in range(100)]
    log = spark.createDataFrame(rows, "prediction_id string, created_at timestamp")
    log.withColumn("created_date", F.to_date("created_at")).write.partitionBy("created_date").parquet(f"{tmp_path}/log")
    stored = spark.read.parquet(f"{tmp_path}/log")
    recent = predictionlog.most_recent(stored, 10)
    assert [r["prediction_id"] for r in recent.collect()] == [f"p{i}" for i in range(90, 100)]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (recent, sampling.exact_sample(log, "prediction_id", 5, 1))]
    assert not any("TakeOrdered" in p or "GlobalLimit" in p for p in plans)
    assert sampling.exact_sample(log, "prediction_id", 5, 1).count() == 5
    assert sampling.exact_sample(log, "prediction_id", 500, 1).count() == 100


def test_days_before_the_cut_are_not_read(spark, tmp_path):
    from tidewatch.operators.selection import newest as cut

    rows = [(f"p{i}", T0 + timedelta(hours=i)) for i in range(100)]
    log = spark.createDataFrame(rows, "prediction_id string, created_at timestamp")
    log.withColumn("created_date", F.to_date("created_at")).write.partitionBy("created_date").parquet(f"{tmp_path}/log")
    found = cut(spark.read.parquet(f"{tmp_path}/log"), 10, day="created_date")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(created_date" in plan and found.count() == 10
