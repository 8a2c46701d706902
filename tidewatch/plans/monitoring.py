"""One monitoring cycle: newest window against the champion's baseline, decide, maybe retrain."""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.operators import cycles, decisions, drift, predictionlog
from tidewatch.operators.decisions import MonitorPolicy, RetrainPolicy
from tidewatch.operators.drift import DriftPolicy
from tidewatch.plans import lifecycle
from tidewatch.plans.retraining import record_attempt, run_retraining
from tidewatch.plans.training import TrainingPolicy
from tidewatch.sources.tables import CYCLE_SCHEMA, Workspace


def recent_window(
    spark: SparkSession, ws: Workspace, model: str, at: datetime, policy: MonitorPolicy = MonitorPolicy()
) -> DataFrame:
    """The predictions of the policy's window with their labels, features as columns.

    The window starts ``days`` before ``at``; only its day partitions are read. It holds all
    rows since then, or the newest ``window`` of them where that is set. Only feedback for its ids is aggregated.
    """
    log = ws.predictions(spark).where(F.col("model_name") == model)
    if policy.days is not None:
        since = at - timedelta(days=policy.days)
        log = log.where((F.col("created_date") >= F.lit(since.date())) & (F.col("created_at") > F.lit(since)))
    window = predictionlog.most_recent(log, policy.window) if policy.window else log
    ids = window.select("prediction_id")
    feedback = ws.feedback(spark).join(ids, "prediction_id", "left_semi")
    return predictionlog.decode_features(predictionlog.attach_feedback(window, feedback))


def _report_rows(report: DataFrame) -> list[dict[str, Any]]:
    """At most one row per monitored column."""
    return [r.asDict() for r in cycles.without_infinities(report).orderBy("feature").collect()]


def run_cycle(
    spark: SparkSession,
    ws: Workspace,
    model: str,
    at: datetime,
    policy: MonitorPolicy = MonitorPolicy(),
    drift_policy: DriftPolicy = DriftPolicy(),
    retrain: RetrainPolicy = RetrainPolicy(),
    training: TrainingPolicy = TrainingPolicy(),
    allow_retrain: bool = True,
    debounce: bool = True,
) -> dict[str, Any]:
    """Run a cycle, append it to ``monitor_cycles`` and return it."""
    current = lifecycle.champion(spark, ws, model)
    facts: dict[str, Any] = {
        "model_name": model,
        "cycle_ts": at,
        "model_version": str(current["version"]) if current else None,
        "run_id": current["run_id"] if current else None,
        "window_size": 0,
        "drifted_features": [],
        "n_labeled": 0,
        "allowed": allow_retrain,
    }
    features: list[dict[str, Any]] = []
    if facts["run_id"]:
        window = recent_window(spark, ws, model, at, policy).persist()
        try:
            facts["window_size"] = window.count()
            if facts["window_size"] >= policy.min_window:
                reference, evaluation = ws.load_baseline(spark, model, current["version"])
                reference = reference.persist()
                report = drift.drift_report(
                    reference,
                    window,
                    CHURN.with_role("numeric"),
                    CHURN.with_role("categorical"),
                    CHURN.with_role("binary"),
                    drift_policy,
                    evaluation,
                    window,
                ).persist()
                features = _report_rows(report)
                summary = drift.dataset_drift(report, drift_policy).first()
                report.unpersist()
                reference.unpersist()
                live = decisions.live_performance(
                    window, facts["model_version"], policy
                ).first()
                measured = live.asDict()
                n_labeled, below = measured.pop("n_labeled"), measured.pop("below")
                facts |= {
                    "drift_share": summary["drift_share"],
                    "dataset_drift": summary["dataset_drift"],
                    "drifted_features": summary["drifted_features"],
                    "prediction_psi": summary["prediction_psi"],
                    "n_labeled": n_labeled,
                    "below": below,
                    "live": {k: v for k, v in measured.items() if v is not None} or None,
                }
        finally:
            window.unpersist()

    names = [c.split()[0] for c in CYCLE_SCHEMA.split(", ")]

    def one_row(values: dict[str, Any]) -> DataFrame:
        return spark.createDataFrame([tuple(values.get(c) for c in names)], CYCLE_SCHEMA)

    stated = decisions.cycle_status(one_row(facts), policy, drift_policy.share).first()
    facts |= {c: stated[c] for c in ("status", "retrain_reasons", "triggered")}
    facts["evaluated"] = facts["status"] not in ("no_model", "insufficient_data")

    outcome: Row | None = None
    if facts["triggered"] and allow_retrain:
        fire, streak = True, retrain.persistence
        if debounce:
            past = ws.cycles(spark).where(F.col("model_name") == model).select(*names)
            series = decisions.debounce(
                past.unionByName(one_row(facts)),
                retrain.persistence,
                evaluated="evaluated",
                allow="allowed",
            )
            latest = series.where(F.col("cycle_ts") == F.lit(at)).first()
            fire, streak = latest["fire"], latest["streak"]
        if fire:
            outcome = run_retraining(
                spark, ws, model, at, retrain, training, facts["retrain_reasons"]
            )
        else:
            outcome = record_attempt(
                spark, ws, model, at,
                trigger_reasons=facts["retrain_reasons"], champion_version=current["version"] if current else None,
                streak=streak, required=retrain.persistence,
            )
    facts["outcome"] = outcome.status if outcome else None
    detail = {
        "features": features,
        "retraining": outcome.asDict() if outcome else None,
        **{k: facts.get(k) for k in ("status", "window_size", "drift_share", "retrain_reasons")},
    }
    facts["payload"] = json.dumps(detail, sort_keys=True, default=str)
    ws.append(one_row(facts), "monitor_cycles")
    return facts | {"retraining": outcome, "features": features}
