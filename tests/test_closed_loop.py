"""Train, serve, drift, retrain, promote: the whole loop on synthetic customers."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.operators import registry, sampling
from tidewatch.operators.decisions import MonitorPolicy, PromotionPolicy, RetrainPolicy
from tidewatch.plans import lifecycle, monitoring, retraining, scoring, training
from tidewatch.plans.training import Candidate, TrainingPolicy
from tidewatch.sources.synthetic import DriftProfile, generate_customers
from tidewatch.sources.tables import DuplicatePrediction, Workspace
from tidewatch.streaming import events, serving

MODEL = "churn"
START = datetime(2026, 1, 1)
TRAINING = TrainingPolicy(
    folds=2,
    min_rows=200,
    reference_rows=1000,
    candidates=(
        Candidate("linear", "logistic_regression", {"C": [0.1, 1.0]}),
    ),
    promotion=PromotionPolicy(minimums={"roc_auc": 0.7, "f1": 0.3}),
)
MONITOR = MonitorPolicy(window=1500, min_window=100, min_labeled=50)
RETRAIN = RetrainPolicy(min_labeled=200, max_fresh=1500, min_training=200, cooldown_minutes=0)


def serve(spark, ws, customers, start, with_feedback=True):
    """Score customers with the champion, log them and, later, their outcomes."""
    model, name, version, _ = scoring.load_model(spark, ws, f"models:/{MODEL}@champion")
    scored = scoring.score(model, customers)
    created = (F.lit(start) + F.make_dt_interval(secs=F.regexp_extract(CHURN.key, r"(\d+)", 1).cast("int") % 100000)).cast("timestamp")
    rows = scoring.to_log_rows(scored.withColumn("actual", F.col(CHURN.target)), name, version, created, F.concat_ws("-", F.lit(str(version)), CHURN.key))
    ws.append_predictions(rows)
    if with_feedback:
        labels = scored.select(
            F.concat_ws("-", F.lit(str(version)), CHURN.key).alias("prediction_id"),
            F.col(CHURN.target).alias("actual"),
            F.lit(start + timedelta(days=1)).alias("feedback_at"),
        )
        ws.append(labels, "feedback")


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    ws = Workspace(str(tmp_path_factory.mktemp("ws")))
    result = training.run_training(spark, ws, MODEL, TRAINING, n=1500, at=START)
    return ws, result


def test_training_selects_registers_and_promotes(spark, trained):
    ws, result = trained
    assert result.promoted and result.version == 1
    assert result.test_metrics["roc_auc"] > 0.75
    assert len(result.candidates) == 2
    assert lifecycle.champion(spark, ws, MODEL)["version"] == 1
    assert lifecycle.resolve(spark, ws, f"models:/{MODEL}@challenger")["version"] == 1
    reference, evaluation = ws.load_baseline(spark, MODEL, 1)
    assert reference.count() == 1000 and evaluation.count() == 300
    tags = {r["key"]: r["value"] for r in ws.tags(spark).collect()}
    assert tags[registry.TAG_DECISION] == "promoted"
    assert {r["key"] for r in ws.runs(spark).collect()} >= {"train_digest", "test_roc_auc", "candidates"}
    assert training.run_training(spark, ws, MODEL, TRAINING, skip_if_champion=True) is None


def test_scoring_keeps_rows_and_decides_on_unrounded_probability(spark, trained):
    ws, _ = trained
    model, *_ = scoring.load_model(spark, ws, f"models:/{MODEL}/1")
    rows = generate_customers(spark, 200, 5).withColumn("note", F.lit("kept"))
    odd = rows.withColumn("payment_method", F.lit("cash")).withColumn("tenure_months", F.lit(None).cast("int"))
    scored = scoring.score(model, odd)
    assert scored.columns == [*odd.columns, "churn_probability", "churn_prediction"]
    assert scored.where("churn_probability BETWEEN 0 AND 1").count() == 200
    assert scored.where("payment_method = 'cash' AND total_charges IS NULL").count() == odd.where("total_charges IS NULL").count()
    assert scoring.score_output(scored).columns == [CHURN.key, "churn_probability", "churn_prediction"]


def test_unknown_models_are_errors(spark, trained):
    ws, _ = trained
    with pytest.raises(registry.UnknownModel):
        lifecycle.resolve(spark, ws, f"models:/{MODEL}@nobody")
    with pytest.raises(registry.UnknownModel):
        lifecycle.roll_back(spark, ws, MODEL, START)


def test_loop_detects_drift_debounces_retrains_and_promotes(spark, trained):
    ws, _ = trained
    empty = monitoring.run_cycle(spark, ws, MODEL, START + timedelta(hours=1), MONITOR)
    assert empty["status"] == "insufficient_data" and empty["outcome"] is None
    assert monitoring.run_cycle(spark, ws, "nobody", START, MONITOR)["status"] == "no_model"

    serve(spark, ws, generate_customers(spark, 600, 77), START + timedelta(days=1))
    with pytest.raises(DuplicatePrediction):
        serve(spark, ws, generate_customers(spark, 5, 77), START + timedelta(days=1))
    assert ws.predictions(spark).count() == 600
    calm = monitoring.run_cycle(spark, ws, MODEL, START + timedelta(days=2), MONITOR, retrain=RETRAIN, training=TRAINING)
    assert calm["status"] == "ok" and not calm["retrain_reasons"]
    assert calm["live"]["roc_auc"] > 0.75 and len(calm["features"]) == 12

    shifted = DriftProfile.of_strength(1.0)
    serve(spark, ws, generate_customers(spark, 1500, 9, shifted, id_offset=10_000), START + timedelta(days=3))
    first = monitoring.run_cycle(spark, ws, MODEL, START + timedelta(days=4), MONITOR, retrain=RETRAIN, training=TRAINING)
    assert first["dataset_drift"] and "monthly_charges" in first["drifted_features"]
    assert first["outcome"] == "pending"
    second = monitoring.run_cycle(spark, ws, MODEL, START + timedelta(days=5), MONITOR, retrain=RETRAIN, training=TRAINING)
    outcome = second["retraining"]
    assert outcome.status == "promoted", outcome
    assert (outcome.n_fresh_train, outcome.n_holdout, outcome.n_reference) == (1125, 375, 0)
    assert outcome.challenger_score >= outcome.champion_score + 0.01
    assert lifecycle.champion(spark, ws, MODEL)["version"] == 2
    assert ws.cycles(spark).count() == 5

    cool = retraining.run_retraining(spark, ws, MODEL, START + timedelta(days=5, minutes=1), RetrainPolicy())
    assert (cool.status, cool.reason) == ("skipped", "cooldown")
    few = retraining.run_retraining(spark, ws, MODEL, START + timedelta(days=9), RetrainPolicy(min_labeled=5000))
    assert few.reason == "too_few_labels"

    lifecycle.promote_by_hand(spark, ws, MODEL, 1, START + timedelta(days=6))
    assert lifecycle.champion(spark, ws, MODEL)["version"] == 1
    lifecycle.move_alias(spark, ws, MODEL, "champion", 2, START + timedelta(days=7))
    assert lifecycle.roll_back(spark, ws, MODEL, START + timedelta(days=8)) == 1
    replaced = ws.tags(spark).where(F.col("key") == registry.TAG_REPLACED_BY).first()
    assert (replaced["version"], replaced["value"]) == (2, "1")


def test_a_stream_is_served_by_the_champion_of_the_moment(spark, trained, tmp_path):
    ws, _ = trained
    lifecycle.move_alias(spark, ws, MODEL, "champion", 1, START + timedelta(days=30))
    customers = generate_customers(spark, 30, 4)
    for part in (0, 1):
        half = customers.where(F.crc32(F.col(CHURN.key).cast("binary")) % 2 == part)
        half.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(customers.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    swaps = []
    run = serving.serve_with_champion(
        spark, ws, MODEL, F.current_timestamp(), F.md5(F.col(CHURN.key).cast("binary")),
        swapped=lambda old, new: swaps.append((old, new)),
    )
    events.start(stream, run, f"{tmp_path}/cp").awaitTermination()
    served = spark.read.parquet(ws.path("served"))
    assert served.count() == 30 and swaps == [(None, 1)]
    assert served.select("model_version").distinct().collect()[0][0] in ("1", 1)
    model, *_ = scoring.load_model(spark, ws, f"models:/{MODEL}@champion")
    direct = serving.score_stream(model, customers).agg(F.sum("churn_probability")).first()[0]
    assert served.agg(F.sum("churn_probability")).first()[0] == pytest.approx(direct)


def test_grid_and_estimators():
    assert training.expand_grid({"b": [1, 2], "a": ["x"]}) == [{"a": "x", "b": 1}, {"a": "x", "b": 2}]
    assert training.expand_grid({}) == [{}]
    with pytest.raises(ValueError):
        training.build_classifier("svm", {}, 1, 10)


def test_sampling_labels_is_independent_of_attributes(spark):
    rows = generate_customers(spark, 6000, 3)
    kept = sampling.bernoulli_sample(rows, CHURN.key, 0.5, "feedback")
    shares = lambda df: {r["contract_type"]: r["n"] for r in df.groupBy("contract_type").agg(F.count("*").alias("n")).collect()}
    all_rows, some = shares(rows), shares(kept)
    for name, n in all_rows.items():
        assert abs(some[name] / n - 0.5) < 0.06
