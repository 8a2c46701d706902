"""Tail probabilities of the drift tests, as columns."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

EXACT_ROWS = 10_000  # of the larger sample; beyond, the limit law holds to all digits shown
_PI = 3.141592653589793


def _paths_inside(n: int, m: int, gap: float) -> float:
    """Share of lattice paths from (0, 0) to (n, m) whose distance from the diagonal stays below gap / (n m)."""
    bound = 0.5 + np.floor(gap - 1e-7)  # between two possible distances
    share = np.zeros(n + 2)  # of paths to the points of a diagonal, by steps along n; share[0] is outside
    share[1] = 1.0
    for k in range(1, n + m + 1):
        low = max(0, k - m, int(np.ceil((k * n - bound) / (n + m))))
        high = min(n, k, int(np.floor((k * n + bound) / (n + m))))
        if low > high:
            return 0.0
        i = np.arange(low, high + 1)
        inside = share[low : high + 1] * (i / k) + share[low + 1 : high + 2] * ((k - i) / k)
        share[max(0, low - 1) : low + 1] = 0.0  # the band moves by one at most
        share[low + 1 : high + 2] = inside
        share[high + 2 :] = 0.0
    return float(share[n + 1])


@pandas_udf(DoubleType())
def kolmogorov_exact(n: pd.Series, m: pd.Series, gap: pd.Series) -> pd.Series:
    """P(D >= gap / (n m)) of two samples of one continuous law; NULL beyond ``EXACT_ROWS``."""
    out = []
    for a, b, g in zip(n, m, gap):
        usable = a == a and b == b and g == g and 0 < a <= EXACT_ROWS and 0 < b <= EXACT_ROWS
        out.append(min(1.0, max(0.0, 1.0 - _paths_inside(int(a), int(b), g))) if usable else None)
    return pd.Series(out, dtype="float64")


def log_gamma(a: Column) -> Column:
    """Logarithm of the gamma function for a > 0: Stirling's series, eight steps up."""
    z = a + 8.0
    product = a
    for i in range(1, 8):
        product = product * (a + float(i))
    series = 1 / (12.0 * z) - 1 / (360.0 * z * z * z) + 1 / (1260.0 * F.pow(z, F.lit(5.0))) - 1 / (1680.0 * F.pow(z, F.lit(7.0)))
    return (z - 0.5) * F.ln(z) - z + 0.9189385332046727 + series - F.ln(product)


def normal_survival(z: Column) -> Column:
    """P(X >= z) of a standard normal variable."""
    half = error_function_complement(F.abs(z) / F.sqrt(F.lit(2.0))) / 2.0
    return F.when(z < 0, 1.0 - half).otherwise(half)


def error_function_complement(z: Column) -> Column:
    """erfc(z) for z >= 0: all-positive series below 2.5, continued fraction above."""
    zz = z * z
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(80)),
        F.struct(z.alias("term"), z.alias("total")),
        lambda acc, k: F.struct(
            (acc["term"] * 2.0 * zz / (2.0 * k + 1.0)).alias("term"),
            (acc["total"] + acc["term"] * 2.0 * zz / (2.0 * k + 1.0)).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    small = 1.0 - series * F.exp(-zz) * 2.0 / F.sqrt(F.lit(_PI))
    tail = F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), z, lambda acc, k: z + (k / 2.0) / acc)
    large = F.exp(-zz) / F.sqrt(F.lit(_PI)) / tail
    return F.when(z < 2.5, small).otherwise(large)


STEPS = 20_000
FAR = 2_000_000.0  # half degrees of freedom from which the cube-root normal law is used


def chi_squared_survival(statistic: Column, dof: Column) -> Column:
    """P(X >= statistic) for a chi-squared variable: the upper incomplete gamma function.

    Below the mean by its series, above by its continued fraction. Both need some multiple of
    the root of the degrees of freedom as steps and keep three or four numbers, whatever the
    number of categories. Beyond four million degrees the cube root of the variable is normal
    to all digits shown.
    """
    a, x = dof.cast("double") / 2.0, statistic.cast("double") / 2.0
    count = F.least(F.lit(STEPS), F.lit(80) + F.ceil(12.0 * F.sqrt(F.greatest(a, F.lit(0.0)))).cast("int"))
    steps = F.sequence(F.lit(1), count)
    front = F.exp(a * F.ln(x) - x - log_gamma(a))
    series = F.aggregate(
        steps,
        F.struct((1.0 / a).alias("term"), (1.0 / a).alias("total")),
        lambda s, k: F.struct(
            (s["term"] * x / (a + k)).alias("term"), (s["total"] + s["term"] * x / (a + k)).alias("total")
        ),
        lambda s: s["total"],
    )
    # The fraction is evaluated from its end: x + 1 - a - 1(1 - a) / (x + 3 - a - 2(2 - a) / ...
    fraction = F.aggregate(
        F.reverse(steps), x + 1.0 - a + 2.0 * (count + 1), lambda s, k: x - 1.0 - a + 2.0 * k - k * (k - a) / s
    )
    scaled = F.pow(x / a, F.lit(1.0 / 3)) - (1.0 - 1.0 / (9.0 * a))
    return (
        F.when((statistic <= 0) | (dof < 1), F.lit(1.0))
        .when(a > FAR, normal_survival(scaled * F.sqrt(9.0 * a)))
        .when(x < a + 1.0, 1.0 - front * series)
        .otherwise(front / fraction)
    )
