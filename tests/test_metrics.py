import math

import numpy as np
import pytest

from tidewatch.operators import metrics
from tidewatch.operators.decisions import live_performance, MonitorPolicy


def frame(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def all_metrics(spark, y, p, threshold=0.35):
    return metrics.binary_metrics(frame(spark, y, p), "p", "y", threshold).first()


def test_perfect_ranking(spark):
    row = all_metrics(spark, [0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9], 0.5)
    assert (row["roc_auc"], row["f1"], row["accuracy"], row["average_precision"]) == (1, 1, 1, 1)


def test_threshold_moves_recall_but_not_auc(spark):
    y, p = [0, 1, 1, 0, 1], [0.2, 0.4, 0.7, 0.3, 0.9]
    low, high = all_metrics(spark, y, p, 0.35), all_metrics(spark, y, p, 0.5)
    assert low["recall"] == 1 and high["recall"] == pytest.approx(2 / 3)
    assert low["roc_auc"] == high["roc_auc"]


def test_one_class_has_no_ranking_metrics(spark):
    row = all_metrics(spark, [1, 1, 1], [0.2, 0.6, 0.9])
    assert math.isnan(row["roc_auc"]) and math.isnan(row["average_precision"])
    assert row["recall"] == pytest.approx(2 / 3)


def test_against_brute_force_with_ties(spark):
    rng = np.random.default_rng(1)
    y, p = rng.integers(0, 2, 400), np.round(rng.random(400), 1)
    row = all_metrics(spark, y, p)
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).mean() + 0.5 * (pos[:, None] == neg[None, :]).mean()
    assert row["roc_auc"] == pytest.approx(wins)
    ap, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit, flagged = ((p >= t) & (y == 1)).sum(), (p >= t).sum()
        ap += (hit / (y == 1).sum() - before) * hit / flagged
        before = hit / (y == 1).sum()
    assert row["average_precision"] == pytest.approx(ap)
    q = np.clip(p, 1e-7, 1 - 1e-7)
    assert row["log_loss"] == pytest.approx(-np.mean(np.where(y == 1, np.log(q), np.log(1 - q))))
    assert row["brier_score"] == pytest.approx(np.mean((q - y) ** 2))


def test_auc_does_not_change_under_a_monotone_map_or_partitioning(spark):
    rng = np.random.default_rng(2)
    y, p = rng.integers(0, 2, 300), rng.random(300)
    a = metrics.roc_auc(frame(spark, y, p), "p", "y").first()[0]
    b = metrics.roc_auc(frame(spark, y, p**3).repartition(7), "p", "y").first()[0]
    assert a == pytest.approx(b, abs=1e-12)


def test_curves_start_and_end_where_they_should(spark):
    df = frame(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    roc = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "p", "y").collect())
    assert roc == [(0.0, 0.0), (0.0, 0.5), (0.5, 0.5), (0.5, 1.0), (1.0, 1.0)]
    pr = {(r["recall"], r["precision"]) for r in metrics.pr_curve(df, "p", "y").collect()}
    assert {(0.0, 1.0), (0.5, 1.0), (1.0, 0.5)} <= pr


def test_best_candidate_takes_the_first_of_equals(spark):
    rows = [(0, 0.8), (1, 0.9), (2, 0.9), (3, float("nan"))]
    df = spark.createDataFrame(rows, "candidate int, roc_auc_mean double")
    assert metrics.best_candidate(df, "roc_auc", "candidate").first()["candidate"] == 1


def test_live_performance_counts_the_champion_only(spark):
    rows = [(1, 0.9, "2"), (0, 0.1, "2")] * 60 + [(None, 0.5, "2")] * 10
    window = spark.createDataFrame(rows, "actual int, churn_probability double, model_version string")
    assert live_performance(window, "1").first()["n_labeled"] == 0
    row = live_performance(window, "2").first()
    assert (row["n_labeled"], row["roc_auc"], row["below"]) == (120, 1.0, [])
    from pyspark.sql import functions as F

    inverted = window.withColumn("churn_probability", 1 - F.col("churn_probability"))
    assert live_performance(inverted, "2").first()["below"] == ["roc_auc"]
    few = live_performance(window, "2", MonitorPolicy(min_labeled=121)).first()
    assert (few["n_labeled"], few["roc_auc"]) == (120, None)


def test_negatives_only_and_no_rows(spark):
    row = all_metrics(spark, [0, 0], [0.2, 0.9])
    assert math.isnan(row["roc_auc"]) and row["recall"] == 0 and row["accuracy"] == 0.5
    empty = metrics.binary_metrics(frame(spark, [0], [0.1]).where("y = 1"), "p", "y").first()
    assert empty["n_samples"] is None
    assert metrics.roc_curve(frame(spark, [0, 0], [0.2, 0.9]), "p", "y").count() == 3


def test_nan_scores_are_left_out(spark):
    assert all_metrics(spark, [1, 0, 0, 1], [0.9, 0.1, float("nan"), float("nan")]) == all_metrics(spark, [1, 0], [0.9, 0.1])


def test_one_fold_is_refused(spark):
    from tidewatch.operators.sampling import stratified_folds

    with pytest.raises(ValueError):
        stratified_folds(frame(spark, [1, 0], [0.9, 0.1]), "p", "y", folds=1)
