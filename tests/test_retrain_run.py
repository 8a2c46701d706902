"""A whole retraining run on logged predictions: sets, challenger, gate, and the attempt's row."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.operators.decisions import PromotionPolicy, RetrainPolicy
from tidewatch.operators.features import build_pipeline
from tidewatch.plans import lifecycle, retraining, scoring, training
from tidewatch.plans.training import Candidate, TrainingPolicy
from tidewatch.sources.synthetic import DriftProfile, generate_customers
from tidewatch.sources.tables import Workspace, coerced_for_contract

START = datetime(2026, 1, 1)
TRAINING = TrainingPolicy(
    folds=2,
    min_rows=50,
    candidates=(Candidate("linear", "logistic_regression", {"C": [1.0]}),),
    promotion=PromotionPolicy(minimums={"roc_auc": 0.6}),
)
RETRAIN = RetrainPolicy(min_labeled=100, max_fresh=400, min_training=320, cooldown_minutes=0)


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    """A champion fitted on calm customers, and shifted customers it scored, all labeled."""
    ws = Workspace(str(tmp_path_factory.mktemp("ws")))
    calm = coerced_for_contract(generate_customers(spark, 300, 3)).persist()
    model = build_pipeline(training.build_classifier("logistic_regression", {}, 1, 300)).fit(calm)
    version = lifecycle.register_version(spark, ws, "churn", "run-1", {}, START)
    model.write().save(ws.model_path("churn", version))
    ws.save_baseline(calm, scoring.with_probability(model, calm, "churn_probability").select("churn_probability", CHURN.target), "churn", version)
    lifecycle.move_alias(spark, ws, "churn", "champion", version, START)
    shifted = generate_customers(spark, 400, 9, DriftProfile.of_strength(1.0), id_offset=10_000)
    scored = scoring.score(model, shifted)
    created = F.lit(START) + F.make_dt_interval(secs=F.regexp_extract(CHURN.key, r"(\d+)", 1).cast("int") % 100000)
    ids = F.concat_ws("-", F.lit("1"), CHURN.key)
    rows = scoring.to_log_rows(scored, "churn", str(version), created.cast("timestamp"), ids)
    ws.append_predictions(rows)
    labels = scored.select(ids.alias("prediction_id"), F.col(CHURN.target).alias("actual"), F.lit(START + timedelta(days=2)).alias("feedback_at"))
    ws.append(labels, "feedback")
    return ws


def test_a_run_is_recorded_with_its_scores_and_sizes(spark, served):
    at = START + timedelta(days=3)
    row = retraining.run_retraining(spark, served, "churn", at, RETRAIN, TRAINING, ["drift in 1 feature"])
    assert row.status in ("promoted", "rejected"), row.reason[:3000]
    assert (row.n_fresh_train, row.n_holdout, row.n_reference) == (300, 100, 20)
    assert row.version == 2 and row.challenger_score > 0.5 and row.champion_score > 0.5
    champion = lifecycle.champion(spark, served, "churn")["version"]
    assert champion == row.champion_version == (2 if row.status == "promoted" else 1)
    stored = served.retrainings(spark).where(F.col("version") == 2).first()
    assert (stored["status"], stored["trigger"], stored["at"]) == (row.status, "monitoring", at)
