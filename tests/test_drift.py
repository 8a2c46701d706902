import math

import numpy as np
import pandas as pd
import pytest

from tidewatch.contract import CHURN
from tidewatch.operators import drift
from tidewatch.sources.synthetic import DriftProfile, generate_customers

rng = np.random.default_rng(0)


def column(spark, values):
    return spark.createDataFrame(pd.DataFrame({"x": np.asarray(values, dtype=float)}))


def psi(spark, ref, cur):
    return drift.psi_numeric(column(spark, ref), column(spark, cur), ["x"]).first()["psi"]


def words(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def by_hand(ref, cur, bins=10):
    ref, cur = np.sort(ref), np.asarray(cur)
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, bins + 1)[1:-1]))
    share = [np.maximum(np.bincount(np.searchsorted(edges, s, side="right"), minlength=len(edges) + 1) / len(s), 1e-4) for s in (ref, cur)]
    return float(np.sum((share[1] - share[0]) * np.log(share[1] / share[0])))


def test_psi_equals_the_definition_and_grows_with_the_shift(spark):
    ref = rng.normal(0, 1, 5000)
    same, small, large = (rng.normal(m, 1, 2000) for m in (0.0, 0.2, 1.0))
    got = [psi(spark, ref, s) for s in (same, small, large)]
    assert got == pytest.approx([by_hand(ref, s) for s in (same, small, large)], rel=1e-9)
    assert got[0] < 0.02 < got[1] < 0.2 < got[2]


def test_psi_of_itself_missing_values_and_ties(spark):
    values = [1.0, 2.0, float("nan"), 3.0, 4.0] * 100
    assert psi(spark, values, values) == pytest.approx(0.0, abs=1e-12)
    assert math.isnan(psi(spark, values, [float("nan")]))
    ref = rng.poisson(1.0, 5000)
    assert psi(spark, ref, rng.poisson(1.0, 2000)) < 0.02
    assert psi(spark, ref, rng.poisson(2.5, 2000)) > 0.2


def test_categorical_psi_and_chi_squared(spark):
    half = words(spark, ["a"] * 500 + ["b"] * 500)

    def result(cur):
        return drift.categorical_drift(half, words(spark, cur), ["x"]).first()

    assert result(["b", "a"] * 500)["psi"] < 1e-9
    assert result(["b", "a"] * 500)["p_value"] == pytest.approx(1.0)
    assert result(["a"] * 900 + ["b"] * 100)["psi"] > 0.2
    assert result(["a"] * 500 + ["c"] * 500)["psi"] > 1.0
    one = words(spark, ["x"] * 10)
    row = drift.categorical_drift(one, one, ["x"]).first()
    assert (row["statistic"], row["p_value"]) == (0.0, 1.0)
    # 2 x 3 table; statistic and tail by hand: dof 2 tail is exp(-x/2)
    row = drift.categorical_drift(words(spark, list("aabbcc")), words(spark, list("aaaabc")), ["x"]).first()
    assert row["statistic"] == pytest.approx(4 / 3) and row["p_value"] == pytest.approx(math.exp(-2 / 3))


def test_tail_functions(spark):
    from pyspark.sql import functions as F

    from tidewatch.functions.columns import chi_squared_survival, kolmogorov_survival

    # Reference values of the chi-squared tail from published tables.
    cases = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251178, 3, 0.05),
             (18.307038053275146, 10, 0.05), (24.995790139728616, 15, 0.05), (0.0, 4, 1.0), (200.0, 1, 2.0884e-45)]
    df = spark.createDataFrame(cases, "x double, dof long, p double")
    for r in df.withColumn("got", chi_squared_survival(F.col("x"), F.col("dof"))).collect():
        assert r["got"] == pytest.approx(r["p"], rel=1e-4)
    got = spark.range(1).select(kolmogorov_survival(F.lit(1.0)), kolmogorov_survival(F.lit(0.0)), kolmogorov_survival(F.lit(9.0))).first()
    assert got[0] == pytest.approx(0.2699996716, abs=1e-9) and got[1] == 1.0 and got[2] < 1e-60


def test_kolmogorov_smirnov(spark):
    a, b = rng.normal(0, 1, 500), rng.normal(2, 1, 500)
    row = drift.ks_two_sample(column(spark, a), column(spark, b), ["x"]).first()
    grid = np.concatenate([a, b])
    by_definition = max(abs((a <= v).mean() - (b <= v).mean()) for v in grid)
    assert row["statistic"] == pytest.approx(by_definition) and row["p_value"] < 1e-6
    row = drift.ks_two_sample(column(spark, a), column(spark, [float("nan")]), ["x"]).first()
    assert (row["statistic"], row["p_value"]) == (0.0, 1.0)


def roles():
    return CHURN.with_role("numeric"), CHURN.with_role("categorical"), CHURN.with_role("binary")


def test_no_alarm_on_a_fresh_sample_and_market_shift_is_found(spark):
    reference = generate_customers(spark, 4000, 1).persist()
    calm = drift.drift_report(reference, generate_customers(spark, 1000, 2), *roles()).collect()
    assert len(calm) == 11 and not any(r["drift_detected"] for r in calm)
    moved = generate_customers(spark, 1000, 3, DriftProfile.of_strength(0.8))
    report = drift.drift_report(reference, moved, *roles()).persist()
    summary = drift.dataset_drift(report).first()
    assert {"monthly_charges", "num_support_tickets"} <= set(summary["drifted_features"])
    assert "senior_citizen" not in summary["drifted_features"]
    assert summary["dataset_drift"] and summary["drift_share"] == pytest.approx(summary["n_drifted"] / 11)


def test_score_drift_is_reported_apart_from_the_inputs(spark):
    ref, cur = column(spark, rng.beta(2, 5, 1000)), column(spark, rng.beta(5, 2, 500))
    report = drift.drift_report(ref, ref, ["x"], reference_scores=ref, current_scores=cur, score="x")
    row = drift.dataset_drift(report).first()
    assert row["n_features"] == 1 and row["n_drifted"] == 0 and row["prediction_psi"] > 0.2
