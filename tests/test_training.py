"""Cross-validation of all families, and logistic regressions that are fitted together."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidewatch.operators import logistic
from tidewatch.plans import training
from tidewatch.plans.training import Candidate, TrainingPolicy
from tidewatch.sources.synthetic import generate_customers
from tidewatch.sources.tables import coerced_for_contract


def table(spark, n=900, width=4, groups=3):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, width))
    x[:, -1] = 1.0 - x[:, 0]  # inputs that depend on each other, as one-hot columns do
    y = rng.random(n) < 1 / (1 + np.exp(-(x @ np.array([1.5, -2.0, 0.3, 0.0]) - 1)))
    rows = [(i % groups, float(t), [float(v) for v in r]) for i, (t, r) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "g int, y double, x array<double>").repartition(5)


def fitted(rows, penalties):
    return logistic.fit_logistic(logistic.prepare(rows, F.col("g"), F.col("y"), F.col("x")), penalties)


def test_models_equal_the_ones_fitted_one_by_one(spark):
    rows = table(spark).persist()
    weights = fitted(rows, [0.1, 10.0])
    assert sorted(weights) == [0, 1, 2]
    for group in (0, 2):
        mine = rows.where(F.col("g") == group).withColumn("v", array_to_vector("x"))
        for strength, found in zip([0.1, 10.0], weights[group]):
            one = LogisticRegression(
                featuresCol="v", labelCol="y", regParam=strength / mine.count(), standardization=False,
                maxIter=2000, tol=1e-12,
            ).fit(mine)
            assert found[:-1] == pytest.approx(one.coefficients.toArray(), abs=2e-4)
            assert found[-1] == pytest.approx(one.intercept, abs=2e-4)


def test_the_gradient_is_zero_at_the_end(spark):
    rows = table(spark, 200, groups=1)
    beta = fitted(rows, [0.5])[0][0]
    data = rows.collect()
    x = np.array([[*r["x"], 1.0] for r in data])
    p = 1 / (1 + np.exp(-x @ beta))
    gradient = x.T @ (p - np.array([r["y"] for r in data])) + 0.5 * np.append(beta[:-1], 0.0)
    assert np.abs(gradient).max() < 1e-5


def test_separable_single_class_and_missing_rows(spark):
    rows = [(0, 1.0 if v > 0 else 0.0, [float(v)]) for v in range(-20, 21) if v]
    rows += [(1, 1.0, [float(v)]) for v in range(10)]
    rows += [(2, None, [1.0]), (2, 1.0, None), (None, 1.0, [1.0])]
    found = fitted(spark.createDataFrame(rows, "g int, y double, x array<double>"), [1e-3])
    assert sorted(found) == [0, 1]  # no row of group 2 is complete
    assert np.isfinite(found[0]).all() and found[0][0][0] > 1
    assert found[1][0][1] > 5  # all labels are 1
    empty = spark.createDataFrame([], "g int, y double, x array<double>")
    assert fitted(empty, [1.0]) == {}


def test_scores_are_named_by_candidate(spark):
    rows = logistic.prepare(table(spark, 30), F.col("g"), F.col("y"), F.col("x"))
    weights = {0: np.array([[0, 0, 0, 0, 0.0], [0, 0, 0, 0, 50.0]])}
    got = logistic.score_logistic(rows, weights, [4, 7]).groupBy("candidate", "fit_group").agg(
        F.count("*").alias("n"), F.avg("p").alias("p")
    )
    got = {(r["candidate"], r["fit_group"]): (r["n"], round(r["p"], 6)) for r in got.collect()}
    assert got == {(4, 0): (10, 0.5), (7, 0): (10, 1.0), **{(c, g): (10, 0.5) for c in (4, 7) for g in (1, 2)}}


def test_cross_validation_of_three_families(spark):
    rows = coerced_for_contract(generate_customers(spark, 800, 6)).persist()
    policy = TrainingPolicy(
        folds=2,
        candidates=(
            Candidate("forest", "random_forest", {"n_estimators": [10], "max_depth": [5], "min_samples_leaf": [5]}),
            Candidate("linear", "logistic_regression", {"C": [0.01, 1.0]}),
            Candidate("boosted", "hist_gradient_boosting", {"learning_rate": [0.1], "max_depth": [2], "max_iter": [5]}),
        ),
    )
    best, listed = training.cross_validate(rows, policy)
    assert [c["name"] for c in listed] == ["forest", "linear", "linear", "boosted"]
    assert [c["params"].get("C") for c in listed] == [None, 0.01, 1.0, None]
    assert all(0.6 < c["roc_auc_mean"] < 1 and c["roc_auc_std"] < 0.2 for c in listed)
    assert best["roc_auc_mean"] == max(c["roc_auc_mean"] for c in listed)


def test_families_set_their_parameters():
    forest = training.build_classifier("random_forest", {"n_estimators": 7, "min_samples_leaf": 3}, 9, 100)
    assert (forest.getNumTrees(), forest.getMinInstancesPerNode(), forest.getMaxDepth(), forest.getSeed()) == (7, 3, 8, 9)
    boosted = training.build_classifier("hist_gradient_boosting", {"learning_rate": 0.3}, 9, 100)
    assert (boosted.getStepSize(), boosted.getMaxIter(), boosted.getMaxDepth()) == (0.3, 100, 4)
    linear = training.build_classifier("logistic_regression", {"C": 2.0}, 9, 100)
    assert linear.getRegParam() == pytest.approx(0.005) and not linear.getStandardization()
