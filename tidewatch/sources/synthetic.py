"""A synthetic customer population with a documented churn process, as a DataFrame source.

Every attribute is an inverse-CDF transform of a hash draw on (seed, attribute, row id), so
the table is reproducible row by row, independent of partitioning, and never leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import exp, lgamma, log, pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.contract import CHURN, Contract
from tidewatch.functions.columns import clip, sigmoid, uniform

# The baseline population.
CONTRACT_SHARES = {"month_to_month": 0.55, "one_year": 0.24, "two_year": 0.21}
INTERNET_SHARES = {"dsl": 0.34, "fiber_optic": 0.44, "none": 0.22}
PAYMENT_SHARES = {
    "electronic_check": 0.34,
    "mailed_check": 0.23,
    "bank_transfer": 0.22,
    "credit_card": 0.21,
}
BASE_CHARGE = {"dsl": (55.0, 8.0), "fiber_optic": (85.0, 9.0), "none": (22.0, 2.0)}
MARKET_PRICE = 65.0

# Churn logit at the baseline market, and what a full concept shift adds.
LOGIT_BASE = {
    "intercept": -2.05,
    "month_to_month": 1.30,
    "two_year": -0.90,
    "tenure_months": -0.035,
    "price_gap": 0.020,
    "num_support_tickets": 0.35,
    "electronic_check": 0.55,
    "fiber_optic": 0.45,
    "dsl": 0.0,
    "has_tech_support": -0.50,
    "senior_citizen": 0.30,
    "paperless_billing": 0.20,
}
LOGIT_SHIFT = {
    "intercept": -0.55,
    "tenure_months": 0.035,
    "price_gap": 0.040,
    "electronic_check": -0.55,
    "fiber_optic": -1.25,
    "dsl": 1.20,
}


@dataclass(frozen=True)
class DriftProfile:
    """How far a population has moved from the baseline."""

    price_increase: float = 0.0
    month_to_month_mass: float = 0.0
    fiber_mass: float = 0.0
    ticket_increase: float = 0.0
    concept: float = 0.0

    @staticmethod
    def of_strength(strength: float) -> DriftProfile:
        """Covariate and concept drift scaled together; strength is clipped to [0, 1]."""
        s = min(max(float(strength), 0.0), 1.0)
        return DriftProfile(0.30 * s, 0.20 * s, 0.15 * s, 1.5 * s, s)


def move_mass(shares: Mapping[str, float], target: str, mass: float) -> dict[str, float]:
    """Give ``target`` extra probability, taken from the others in proportion to theirs."""
    rest = sum(p for name, p in shares.items() if name != target)
    moved = min(max(mass, 0.0), rest)
    scaled = {n: p * (1 - moved / rest) if n != target else p + moved for n, p in shares.items()}
    total = sum(scaled.values())
    return {n: p / total for n, p in scaled.items()}


def _gamma_cdf(shape: float, x: float) -> float:
    """Lower regularised incomplete gamma function by its power series."""
    if x <= 0:
        return 0.0
    term = total = 1.0 / shape
    k = shape
    while term > total * 1e-17:
        k += 1.0
        term *= x / k
        total += term
    return min(1.0, total * exp(shape * log(x) - x - lgamma(shape)))


def _poisson_cdf(rate: float) -> list[float]:
    """P(N <= k) for k = 0, 1, ... until what is left is below a 52-bit draw."""
    steps, term, total, k = [], exp(-rate), 0.0, 0
    while 1.0 - total > 1e-15 and k < 200:
        total += term
        steps.append(total)
        k += 1
        term *= rate / k
    return steps


def _steps_passed(draw: Column, steps: Sequence[float]) -> Column:
    """How many steps of a CDF a draw has passed: a discrete inverse CDF."""
    return F.size(F.filter(F.array(*[F.lit(s) for s in steps]), lambda s: s <= draw))


def _pick(draw: Column, shares: Mapping[str, float]) -> Column:
    names = list(shares)
    choice, reached = None, 0.0
    for name in names[:-1]:
        reached += shares[name]
        test = draw < F.lit(reached)
        choice = F.when(test, name) if choice is None else choice.when(test, name)
    return choice.otherwise(names[-1])


def _normal(draw: Column, angle: Column) -> Column:
    return F.sqrt(-2.0 * F.ln(1.0 - draw)) * F.cos(2.0 * pi * angle)


def churn_logit(concept: float = 0.0, market_price: float | Column = MARKET_PRICE) -> Column:
    """The deterministic part of the churn logit over contract columns."""
    c = min(max(float(concept), 0.0), 1.0)
    weight = {k: w + c * LOGIT_SHIFT.get(k, 0.0) for k, w in LOGIT_BASE.items()}
    price = market_price if isinstance(market_price, Column) else F.lit(float(market_price))

    def flag(column: str, value: str) -> Column:
        return (F.col(column) == value).cast("double")

    terms = {
        "month_to_month": flag("contract_type", "month_to_month"),
        "two_year": flag("contract_type", "two_year"),
        "tenure_months": F.col("tenure_months").cast("double"),
        "price_gap": F.col("monthly_charges") - price,
        "num_support_tickets": F.col("num_support_tickets").cast("double"),
        "electronic_check": flag("payment_method", "electronic_check"),
        "fiber_optic": flag("internet_service", "fiber_optic"),
        "dsl": flag("internet_service", "dsl"),
        "has_tech_support": F.col("has_tech_support").cast("double"),
        "senior_citizen": F.col("senior_citizen").cast("double"),
        "paperless_billing": F.col("paperless_billing").cast("double"),
    }
    logit = F.lit(weight["intercept"])
    for name, term in terms.items():
        logit = logit + F.lit(weight[name]) * term
    return logit


def population(
    ids: DataFrame,
    key: str,
    seed: int | str = 42,
    profile: DriftProfile = DriftProfile(),
    contract: Contract = CHURN,
) -> DataFrame:
    """One synthetic customer per row of ``ids``; ``key`` is its integer row id."""

    def draw(attribute: str) -> Column:
        return uniform(f"{seed}-{attribute}", key)

    def normal(attribute: str) -> Column:
        return _normal(draw(attribute), draw(f"{attribute}-angle"))

    contracts = move_mass(CONTRACT_SHARES, "month_to_month", profile.month_to_month_mass)
    internets = move_mass(INTERNET_SHARES, "fiber_optic", profile.fiber_mass)
    out = ids.select(key)
    out = out.withColumns(
        {
            "contract_type": _pick(draw("contract"), contracts),
            "internet_service": _pick(draw("internet"), internets),
            "payment_method": _pick(draw("payment"), PAYMENT_SHARES),
            "paperless_billing": (draw("paperless") < 0.60).cast("int"),
            "senior_citizen": (draw("senior") < 0.16).cast("int"),
            "_tenure": draw("tenure"),
        }
    )
    online = F.col("internet_service") != "none"
    # tenure is rounded to whole months, so the gamma(1.2, scale 14) law of flexible
    # contracts is its CDF at the 72 half-months: an exact inverse CDF, no rejection loop.
    half_months = [_gamma_cdf(1.2, (k + 0.5) / 14.0) for k in range(72)]
    tenure = (
        F.when(
            F.col("contract_type") == "month_to_month", _steps_passed(F.col("_tenure"), half_months)
        )
        .when(F.col("contract_type") == "one_year", F.bround(6 + 66 * F.col("_tenure")))
        .otherwise(F.bround(12 + 60 * F.col("_tenure")))
    )
    out = out.withColumns(
        {
            "tenure_months": tenure.cast("int"),
            "has_tech_support": (online & (draw("support") < 0.35)).cast("int"),
        }
    )
    kind = F.col("internet_service")

    def by_internet(position: int) -> Column:
        (first, a), *rest = BASE_CHARGE.items()
        chosen = F.when(kind == first, F.lit(a[position]))
        for name, values in rest:
            chosen = chosen.when(kind == name, F.lit(values[position]))
        return chosen

    charge = by_internet(0) + by_internet(1) * normal("charge") + 10 * F.col("has_tech_support")
    out = out.withColumn(
        "monthly_charges", F.bround(clip(charge * (1 + profile.price_increase), 18, 250), 2)
    )
    billed = F.col("tenure_months") * F.col("monthly_charges") * (0.92 + 0.13 * draw("billed"))
    fiber, new = kind == "fiber_optic", F.col("tenure_months") < 6
    extra = max(profile.ticket_increase, 0.0)
    tickets = None
    for is_fiber in (True, False):
        for is_new in (True, False):
            steps = _poisson_cdf(0.8 + 0.7 * is_fiber + 0.5 * is_new + extra)
            count = _steps_passed(draw("tickets"), steps)
            test = (fiber == is_fiber) & (new == is_new)
            tickets = F.when(test, count) if tickets is None else tickets.when(test, count)
    usage = F.exp(F.when(fiber, F.lit(log(90.0))).otherwise(F.lit(log(45.0))) + 0.5 * normal("usage"))
    out = out.withColumns(
        {
            "total_charges": F.when(F.col("tenure_months") > 0, F.bround(billed, 2)),
            "num_support_tickets": tickets,
            "avg_monthly_gb": F.when(
                draw("telemetry") >= 0.03, F.when(online, F.bround(usage, 1)).otherwise(0.0)
            ),
        }
    )
    logit = churn_logit(profile.concept, MARKET_PRICE * (1 + profile.price_increase))
    chance = sigmoid(logit + 0.5 * normal("noise"))
    out = out.withColumn(contract.target, (draw("churn") < chance).cast("int"))
    named = F.format_string("C%07d", F.col(key).cast("long")).alias(contract.key)
    return out.select(named, *contract.features, contract.target)


def generate_customers(
    spark: SparkSession,
    n: int,
    seed: int | str = 42,
    profile: DriftProfile = DriftProfile(),
    id_offset: int = 0,
) -> DataFrame:
    """``n`` synthetic customers, numbered from ``id_offset``."""
    if n <= 0:
        raise ValueError("n must be positive")
    return population(spark.range(id_offset, id_offset + n), "id", seed, profile)


def inject_drift(
    customers: DataFrame, profile: DriftProfile, key: str | None = None, seed: int | str = 42
) -> DataFrame:
    """Apply covariate drift to an existing table, row by row and reproducibly.

    Prices are multiplied; categories move to the target with the chance that gives the
    target its extra mass; tickets grow by a Poisson draw.
    """
    key = key or CHURN.key

    def reassign(column: str, shares: Mapping[str, float], target: str, mass: float) -> Column:
        rest = sum(p for n, p in shares.items() if n != target)
        moves = uniform(f"{seed}-{column}", key) < min(max(mass, 0.0), rest) / rest
        return F.when((F.col(column) != target) & moves, F.lit(target)).otherwise(F.col(column))

    factor = F.lit(1 + profile.price_increase)
    extra = _steps_passed(
        uniform(f"{seed}-tickets", key), _poisson_cdf(max(profile.ticket_increase, 0.0))
    )
    return customers.withColumns(
        {
            "monthly_charges": F.col("monthly_charges") * factor,
            "contract_type": reassign(
                "contract_type", CONTRACT_SHARES, "month_to_month", profile.month_to_month_mass
            ),
            "internet_service": reassign(
                "internet_service", INTERNET_SHARES, "fiber_optic", profile.fiber_mass
            ),
            "num_support_tickets": F.col("num_support_tickets") + extra,
        }
    )
