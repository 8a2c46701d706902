"""Tail probabilities against counted paths, published values and numeric integrals."""

import math
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.tails import chi_squared_survival, kolmogorov_exact, log_gamma
from tidewatch.operators import drift


def by_counting(n, m, gap):
    """Share of the orders of two samples whose distance times n m is at least gap."""
    far = total = 0
    for places in combinations(range(n + m), n):
        i = j = most = 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in places else (i, j + 1)
            most = max(most, abs(i * m - j * n))
        total += 1
        far += most >= gap
    return far / total


@pytest.mark.parametrize("n, m", [(1, 1), (3, 3), (4, 5), (6, 3), (2, 7)])
def test_small_samples_by_counting_orders(spark, n, m):
    gaps = [float(g) for g in range(0, n * m + 1)]
    df = spark.createDataFrame([(float(n), float(m), g) for g in gaps], "n double, m double, gap double")
    got = [r[0] for r in df.select(kolmogorov_exact("n", "m", "gap")).collect()]
    assert got == pytest.approx([by_counting(n, m, g) for g in gaps], abs=1e-12)


def test_equal_samples_by_the_closed_form(spark):
    """P(D >= k / n) of two samples of n is an alternating sum of binomials."""
    n = 200
    rows = [(float(n), float(n), float(k * n)) for k in (5, 14, 20, 27, 40)]
    df = spark.createDataFrame(rows, "n double, m double, gap double")
    got = [r[0] for r in df.select(kolmogorov_exact("n", "m", "gap")).collect()]
    want = [
        2 * sum((-1) ** (j + 1) * math.comb(2 * n, n - j * k) / math.comb(2 * n, n) for j in range(1, n // k + 1))
        for k in (5, 14, 20, 27, 40)
    ]
    assert got == pytest.approx(want, abs=1e-9)


def test_published_critical_values(spark):
    """Two samples of 10: a distance of 7 / 10 has probability 0.0123; of 8 and 8: 6 / 8 has 0.0186."""
    df = spark.createDataFrame([(10.0, 10.0, 70.0), (8.0, 8.0, 48.0), (10_001.0, 5.0, 100.0), (0.0, 5.0, 0.0)], "n double, m double, gap double")
    got = [r[0] for r in df.select(kolmogorov_exact("n", "m", "gap")).collect()]
    assert got[0] == pytest.approx(0.0123, abs=5e-5) and got[1] == pytest.approx(0.0186, abs=5e-5)
    assert got[2] is None and got[3] is None


def test_large_samples_come_near_the_limit(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=3000), rng.normal(0.03, 1, 2500)
    sides = [spark.createDataFrame([(float(v),) for v in x], "x double") for x in (a, b)]
    row = drift.ks_two_sample(*sides, ["x"]).first()
    lam = math.sqrt(3000 * 2500 / 5500) * row["statistic"]
    limit = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert row["p_value"] == pytest.approx(limit, abs=0.02) and row["p_value"] != pytest.approx(limit, abs=1e-9)


def test_chi_squared_with_many_categories(spark):
    def integral(x, dof):
        t = np.linspace(x, x + 40 * math.sqrt(2 * dof), 400_001)
        log_density = (dof / 2 - 1) * np.log(t / 2) - t / 2 - math.lgamma(dof / 2) - math.log(2)
        return float(np.trapezoid(np.exp(log_density), t))

    cases = [(dof, dof + z * math.sqrt(2 * dof)) for dof in (3, 12, 101, 5_000, 999_999) for z in (-2.0, 0.0, 0.01, 1.6, 5.0) if dof + z * math.sqrt(2 * dof) > 0]
    df = spark.createDataFrame([(x, dof) for dof, x in cases], "x double, dof long")
    got = [r[0] for r in df.select(chi_squared_survival(F.col("x"), F.col("dof"))).collect()]
    assert got == pytest.approx([integral(x, dof) for dof, x in cases], rel=1e-6, abs=1e-9)
    far = spark.createDataFrame([(5e6 + 1.6448536269514722 * math.sqrt(1e7), 5_000_000)], "x double, dof long")
    assert far.select(chi_squared_survival(F.col("x"), F.col("dof"))).first()[0] == pytest.approx(0.05, abs=2e-4)


def test_log_gamma(spark):
    values = [0.5, 1.0, 1.5, 2.0, 7.5, 100.0, 5e5]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    assert [r[0] for r in df.select(log_gamma(F.col("a"))).collect()] == pytest.approx([math.lgamma(v) for v in values], rel=1e-11, abs=1e-10)
