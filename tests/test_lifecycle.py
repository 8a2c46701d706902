"""Registry, gate, status, debounce, alerts, log and time-series operators on literals."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.functions.columns import compact_time, model_uri_parts
from tidewatch.operators import cycles, decisions, predictionlog, registry, timeseries
from tidewatch.operators.decisions import MonitorPolicy, PromotionPolicy, RetrainPolicy
from tidewatch.sources import synthetic, tables

NAN = float("nan")
T0 = datetime(2026, 1, 1)


def test_promotion_gate_cases(spark):
    policy = PromotionPolicy(minimums={"roc_auc": 0.75})
    cases = [
        (0.8, None, True, "no_champion"), (0.7, None, False, "failed_gate"), (NAN, None, False, "failed_gate"),
        (0.82, 0.80, True, "better"), (0.805, 0.80, False, "not_better"), (0.78, 0.80, False, "not_better"),
        (0.8, NAN, True, "champion_unscored"),
    ]
    rows = [(i, {"roc_auc": a}, None if b is None else {"roc_auc": b}) for i, (a, b, *_) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, challenger map<string,double>, champion map<string,double>")
    got = {r["i"]: (r["promote"], r["outcome"]) for r in decisions.promotion_gate(df, policy).collect()}
    assert got == {i: (p, o) for i, (_, _, p, o) in enumerate(cases)}
    lacking = spark.createDataFrame([({"roc_auc": 0.9}, None)], "challenger map<string,double>, champion map<string,double>")
    assert decisions.promotion_gate(lacking).first()["failed_gates"] == ["f1"]


def test_registry_listing_resolution_and_rollback(spark):
    versions = spark.createDataFrame([("m", v, f"r{v}", "READY", T0 + timedelta(days=v)) for v in (1, 2, 9, 10)], registry.VERSION_SCHEMA)
    events = spark.createDataFrame(
        [("m", "champion", 1, T0), ("m", "champion", 10, T0 + timedelta(days=10)), ("m", "challenger", 10, T0 + timedelta(days=10))],
        registry.ALIAS_SCHEMA,
    )
    tags = spark.createDataFrame(
        [("m", 1, registry.TAG_DECISION, "promoted", T0), ("m", 2, registry.TAG_DECISION, "rejected", T0),
         ("m", 2, registry.TAG_DECISION, "promoted", T0 + timedelta(days=1)), ("m", 9, registry.TAG_DECISION, "rejected", T0)],
        registry.TAG_SCHEMA,
    )
    listing = registry.newest_first(registry.list_versions(versions, events, tags)).collect()
    assert [r["version"] for r in listing] == [10, 9, 2, 1]
    assert listing[0]["aliases"] == ["challenger", "champion"] and listing[1]["aliases"] == []
    assert registry.rollback_targets(versions, events, tags, "champion").first()["target_version"] == 2
    uris = spark.createDataFrame([("models:/m@champion",), ("models:/m/2",), ("models:/m/3",), ("models:/m@x",), ("runs:/abc",)], "uri string")
    found = {r["uri"]: (r["version"], r["resolved_uri"]) for r in registry.resolve_uris(uris, events, versions).collect()}
    assert found == {"models:/m@champion": (10, "models:/m/10"), "models:/m/2": (2, "models:/m/2"), "models:/m/3": (None, None),
                     "models:/m@x": (None, None), "runs:/abc": (None, "runs:/abc")}
    minutes = registry.minutes_since_newest(versions, F.lit(T0 + timedelta(days=10, minutes=90))).first()["minutes"]
    assert minutes == 90.0


@pytest.mark.parametrize("required, pattern, fires", [(2, "TFTT", [3]), (2, "TTTT", [1, 3]), (1, "TFT", [0, 2]), (3, "TTFTTT", [5]), (2, "T-T", [2])])
def test_debounce(spark, required, pattern, fires):
    rows = [("m", T0 + timedelta(minutes=i), c == "T", c != "-") for i, c in enumerate(pattern)]
    df = spark.createDataFrame(rows, "model_name string, cycle_ts timestamp, triggered boolean, evaluated boolean")
    got = decisions.debounce(df, required, evaluated="evaluated").orderBy("cycle_ts").collect()
    assert [i for i, r in enumerate(got) if r["fire"]] == fires


def test_cycle_status_order(spark):
    rows = [(None, None, 0, None, None), ("1", None, 500, None, None), ("1", "r", 150, None, None), ("1", "r", 500, 0.3, 0.6),
            ("1", "r", 500, 0.3, 0.9), ("1", "r", 500, 0.1, 0.9), ("1", "r", 500, 0.1, NAN)]
    df = spark.createDataFrame([(i, *r[:4], ["a", "b"], {"roc_auc": r[4]} if r[4] is not None else None) for i, r in enumerate(rows)],
        "i int, model_version string, run_id string, window_size int, drift_share double, drifted_features array<string>, live map<string,double>")
    got = {r["i"]: (r["status"], len(r["retrain_reasons"])) for r in decisions.cycle_status(df).collect()}
    assert got == {0: ("no_model", 0), 1: ("no_model", 0), 2: ("insufficient_data", 0), 3: ("degraded", 2), 4: ("drift", 1), 5: ("ok", 0), 6: ("ok", 0)}


def test_guards_in_order(spark):
    rows = [(5.0, 1, "r", 900, False), (50.0, None, None, 900, False), (None, 1, None, 900, False), (50.0, 1, "r", 10, False), (50.0, 1, "r", 900, False), (5.0, 1, "r", 900, True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, minutes_since_newest double, champion_version int, champion_run_id string, n_labeled int, forced boolean")
    got = [r["guard"] for r in decisions.retrain_guards(df, force="forced").orderBy("i").collect()]
    assert got == ["cooldown", "no_champion", "champion_without_run", "too_few_labels", None, None]
    off = decisions.retrain_guards(df, RetrainPolicy(enabled=False), force="forced").orderBy("i").collect()
    assert [r["guard"] for r in off][:1] + [off[5]["guard"]] == ["disabled", None]


@pytest.fixture(scope="module")
def log(spark):
    rows = [(f"id-{i}", T0 + timedelta(seconds=i), "m", "1", '{"tenure_months": 3, "avg_monthly_gb": null}', i / 10, int(i >= 5)) for i in range(8)]
    return spark.createDataFrame(rows, predictionlog.LOG_SCHEMA)


def test_log_windows_labels_and_orphans(spark, log):
    feedback = spark.createDataFrame([("id-1", 0, T0), ("id-1", 1, T0 + timedelta(hours=1)), ("id-3", 0, T0), ("gone", 1, T0)], predictionlog.FEEDBACK_SCHEMA)
    assert [r["prediction_id"] for r in predictionlog.most_recent(log, 3).collect()] == ["id-5", "id-6", "id-7"]
    labeled = predictionlog.attach_feedback(log, feedback)
    assert {r["prediction_id"]: r["actual"] for r in predictionlog.most_recent(labeled, 9, labeled_only=True).collect()} == {"id-1": 1, "id-3": 0}
    assert tuple(predictionlog.log_counts(labeled).first()) == (8, 2)
    assert [r["prediction_id"] for r in predictionlog.orphan_feedback(log, feedback).collect()] == ["gone"]
    decoded = predictionlog.decode_features(log).first()
    assert decoded["tenure_months"] == 3 and decoded["avg_monthly_gb"] is None and decoded["payment_method"] is None


def test_batches_are_appended_whole_or_not_at_all(spark, log, tmp_path):
    ws = tables.Workspace(str(tmp_path))
    assert ws.predictions(spark).count() == 0
    ws.append_predictions(log)
    fresh = log.withColumn("prediction_id", F.concat(F.lit("new-"), "prediction_id"))
    for bad in (fresh.unionAll(log.limit(1)), fresh.unionAll(fresh.limit(1))):
        with pytest.raises(tables.DuplicatePrediction):
            ws.append_predictions(bad)
    assert ws.predictions(spark).count() == 8


def test_csv_snapshot_and_sources(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write("customer_id,tenure_months,internet_service,total_charges,extra\nC1,5,none,NaN,x\nC2,,dsl,12.5,y\n")
    rows = tables.read_csv(spark, path).collect()
    assert rows[0]["internet_service"] == "none" and rows[0]["total_charges"] is None and rows[1]["tenure_months"] is None
    with pytest.raises(FileNotFoundError):
        tables.read_csv(spark, path + ".no")
    with pytest.raises(ValueError):
        tables.load_source(spark, "csv")
    with pytest.raises(ValueError):
        synthetic.generate_customers(spark, 0)
    snapshot = tables.write_snapshot(spark.range(3), str(tmp_path / "snap"), "r1")
    assert spark.read.parquet(snapshot).count() == 3
    with pytest.raises(Exception):
        tables.write_snapshot(spark.range(3), str(tmp_path / "snap"), "r1")


def test_synthetic_population(spark):
    rows = synthetic.generate_customers(spark, 4000, 5, id_offset=10)
    assert rows.columns == [CHURN.key, *CHURN.features, CHURN.target]
    again = synthetic.generate_customers(spark, 4000, 5, id_offset=10).repartition(5)
    assert rows.exceptAll(again).isEmpty()
    r = rows.agg(F.avg("churned"), F.min(CHURN.key), F.sum((F.col("total_charges").isNull() != (F.col("tenure_months") == 0)).cast("int"))).first()
    assert 0.20 < r[0] < 0.32 and r[1] == "C0000010" and r[2] == 0
    assert synthetic.move_mass({"a": 0.5, "b": 0.3, "c": 0.2}, "a", 0.2) == pytest.approx({"a": 0.7, "b": 0.18, "c": 0.12})
    assert synthetic.DriftProfile.of_strength(7) == synthetic.DriftProfile(0.30, 0.20, 0.15, 1.5, 1.0)


def test_histogram_quantiles_and_alerts(spark):
    df = spark.createDataFrame([(0.02,)] * 50 + [(0.2,)] * 45 + [(9.0,)] * 5, "x double")
    row = timeseries.histogram_quantiles(df, "x", timeseries.LATENCY_BOUNDS, {"p50": 0.5, "p90": 0.9, "p99": 0.99}).first()
    assert row["p50"] == pytest.approx(0.025) and row["p90"] == pytest.approx(0.1 + 0.15 * 40 / 45) and row["p99"] == 5.0
    values = [0.01, 0.2, 0.3, 0.01, 0.2, NAN]
    samples = spark.createDataFrame([("error_ratio", T0 + timedelta(minutes=5 * i), v) for i, v in enumerate(values)], "metric string, ts timestamp, value double")
    states = [r["state"] for r in timeseries.alert_states(samples).orderBy("ts").collect()]
    assert states == ["inactive", "pending", "firing", "inactive", "pending", "inactive"]


def test_small_functions(spark):
    df = spark.createDataFrame([("models:/churn@champion", T0)], "u string, t timestamp")
    row = df.select(model_uri_parts("u").alias("p"), compact_time("t").alias("s")).first()
    assert (row["p"]["model_name"], row["p"]["alias"], row["p"]["version"], row["s"]) == ("churn", "champion", None, "20260101T000000Z")
    clean = cycles.without_infinities(spark.createDataFrame([(NAN, float("inf"), 1.5)], "a double, b double, c double"))
    assert tuple(clean.first()) == (None, None, 1.5)
    assert CHURN.to_frame(spark).count() == 11
