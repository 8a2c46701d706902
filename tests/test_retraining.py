"""Outcomes of retraining attempts and the sets that a challenger is trained and judged on."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.operators import decisions
from tidewatch.operators.decisions import ATTEMPT_SCHEMA, RetrainPolicy
from tidewatch.plans import retraining
from tidewatch.sources.synthetic import generate_customers
from tidewatch.sources.tables import Workspace, coerced_for_contract

AT = datetime(2026, 3, 1)
FACTS = {
    "stopped": dict(guard="cooldown", error="boom", promoted=True),
    "short": dict(streak=1, required=2, decision="better", trigger_reasons=["drift"]),
    "enough": dict(streak=2, required=2, decision="better", promoted=True),
    "broken": dict(error="ValueError: bad", promoted=True, decision="better"),
    "worse": dict(promoted=False, decision="not better"),
    "unknown": dict(),
}
OUTCOMES = {
    "stopped": ("skipped", "cooldown", "manual"),
    "short": ("pending", "1 of 2 consecutive triggered cycles", "monitoring"),
    "enough": ("promoted", "better", "manual"),
    "broken": ("failed", "ValueError: bad", "manual"),
    "worse": ("rejected", "not better", "manual"),
    "unknown": ("rejected", None, "manual"),
}


def test_outcomes_follow_from_the_facts(spark, tmp_path):
    ws = Workspace(str(tmp_path))
    assert ws.retrainings(spark).count() == 0
    returned = {n: retraining.record_attempt(spark, ws, n, AT, **facts) for n, facts in FACTS.items()}
    stored = {r["model_name"]: r for r in ws.retrainings(spark).collect()}
    for rows in (returned, stored):
        assert {n: (r["status"], r["reason"], r["trigger"]) for n, r in rows.items()} == OUTCOMES
    assert stored["short"]["trigger_reasons"] == ["drift"] and stored["short"]["at"] == AT


def test_outcomes_are_counted_with_their_sizes(spark):
    names = [c.split()[0] for c in ATTEMPT_SCHEMA.split(", ")]
    rows = [dict(model_name="a", guard="cooldown"), dict(model_name="a", guard="disabled")]
    rows += [dict(model_name="b", promoted=True, n_fresh_train=30, n_holdout=n) for n in (5, 7)]
    df = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], ATTEMPT_SCHEMA)
    counts = decisions.outcome_counts(decisions.retrain_outcomes(df)).collect()
    got = {(r["model_name"], r["status"]): (r["n"], r["n_fresh_train"], r["n_reference"], r["n_holdout"]) for r in counts}
    assert got == {("a", "skipped"): (2, 0, 0, 0), ("b", "promoted"): (2, 60, 0, 12)}


@pytest.mark.parametrize("n, least, sizes", [(40, 20, (30, 0, 10)), (40, 50, (30, 20, 10)), (40, 500, (30, 60, 10)), (1, 3, (0, 3, 1))])
def test_sets_hold_the_newest_rows_out_and_top_up(spark, n, least, sizes):
    customers = coerced_for_contract(generate_customers(spark, 100, 8)).withColumn(
        "i", F.regexp_extract(CHURN.key, r"(\d+)", 1).cast("int")
    )
    numbered = customers.withColumn("i", F.row_number().over(W.orderBy("i"))).persist()
    labeled = numbered.where(F.col("i") <= n).select(
        F.col(CHURN.key).alias("prediction_id"),
        F.expr(f"timestamp'{AT:%Y-%m-%d}' + make_dt_interval(0, 0, i, 0)").alias("created_at"),
        F.col(CHURN.target).alias("actual"),
        "i",
        *CHURN.features,
    )
    reference = numbered.where("i > 40").drop("i")
    sets = retraining.retraining_sets(labeled, reference, RetrainPolicy(min_training=least), 7).persist()
    parts = {(r["part"], r["origin"]): r["count"] for r in sets.groupBy("part", "origin").count().collect()}
    found = tuple(parts.get(k, 0) for k in (("train", "fresh"), ("train", "reference"), ("holdout", "fresh")))
    assert found == sizes
    held = {r[0] for r in sets.where("part = 'holdout'").select(CHURN.key).collect()}
    newest = {r["prediction_id"] for r in labeled.where(F.col("i") > n - sizes[2]).collect()}
    assert held == newest


def test_guards_are_recorded(spark, tmp_path):
    ws = Workspace(str(tmp_path))
    row = retraining.run_retraining(spark, ws, "none", AT + timedelta(days=1))
    assert (row.status, row.reason) == ("skipped", "no_champion")
    off = retraining.run_retraining(spark, ws, "none", AT, RetrainPolicy(enabled=False), reasons=["drift"])
    assert (off.status, off.reason, off.trigger) == ("skipped", "disabled", "monitoring")
    assert ws.retrainings(spark).count() == 2
