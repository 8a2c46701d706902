"""Operational metrics: windowed rates, ratios, histograms, quantiles, gauges and alerts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.runs import previous_values, run_lengths

# Upper bucket bounds of the two histograms.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
PROBABILITY_BOUNDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
RATE_FLOOR = 1e-9


def seconds_in(width: str) -> float:
    """Length of a fixed-size interval such as ``5 minutes``."""
    number, unit = width.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return float(number) * scale[unit.rstrip("s")]


def _window(ts: str, width: str, slide: str | None) -> Column:
    return F.window(ts, width, slide) if slide else F.window(ts, width)


def label_counters(events: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Events per combination of labels."""
    return events.groupBy(*labels).agg(F.count(F.lit(1)).alias("n"))


def event_rate(
    events: DataFrame, ts: str, width: str, slide: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Events per second in each window. Events are held, so no counter resets to correct."""
    return (
        events.groupBy(_window(ts, width, slide).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            *by,
            "n",
            (F.col("n") / F.lit(seconds_in(width))).alias("rate"),
        )
    )


def error_ratio(
    requests: DataFrame, ts: str, width: str, slide: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Share of 5xx answers per window, as a ratio of rates with a floored denominator."""
    failed = F.count_if(F.col("status").startswith("5"))
    length = F.lit(seconds_in(width))
    return (
        requests.groupBy(_window(ts, width, slide).alias("w"), *by)
        .agg(F.count(F.lit(1)).alias("n"), failed.alias("n_failed"))
        .select(
            F.col("w.start").alias("window_start"),
            *by,
            "n",
            "n_failed",
            (
                F.col("n_failed") / length / F.greatest(F.col("n") / length, F.lit(RATE_FLOOR))
            ).alias("ratio"),
        )
    )


def score_trend(
    predictions: DataFrame, ts: str, width: str, slide: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Positive share and mean probability per window."""
    return (
        predictions.groupBy(_window(ts, width, slide).alias("w"), *by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(F.col("churn_prediction").cast("double")).alias("positive_share"),
            F.avg("churn_probability").alias("mean_probability"),
        )
        .select(F.col("w.start").alias("window_start"), *by, "n", "positive_share", "mean_probability")
    )


def _bound_counts(value: str, bounds: Sequence[float]) -> list[Column]:
    return [
        F.count_if(F.col(value) <= F.lit(float(b))).alias(f"le_{i}") for i, b in enumerate(bounds)
    ]


def cumulative_histogram(
    events: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """(labels, le, n) with cumulative counts per upper bound, the last one infinite.

    One aggregate with a conditional count per bound; rows are not multiplied by buckets.
    """
    counts = events.where(F.col(value).isNotNull()).groupBy(*by).agg(
        *_bound_counts(value, bounds),
        F.count(F.lit(1)).alias("total"),
        F.sum(value).alias("value_sum"),
    )
    rows = F.array(
        *[
            F.struct(F.lit(str(float(b))).alias("le"), F.col(f"le_{i}").alias("n"))
            for i, b in enumerate(bounds)
        ],
        F.struct(F.lit("+Inf").alias("le"), F.col("total").alias("n")),
    )
    return counts.select(*by, F.inline(rows), "value_sum", F.col("total").alias("value_count"))


def _quantile(q: float, bounds: Sequence[float]) -> Column:
    """Linear interpolation inside the bucket that holds the rank."""
    rank = F.col("total") * F.lit(float(q))
    result = F.when(F.col("total") == 0, F.lit(float("nan")))
    lower, below = 0.0, F.lit(0)
    for i, upper in enumerate(bounds):
        here = F.col(f"le_{i}")
        share = F.try_divide(rank - below, (here - below).cast("double"))
        inside = F.lit(lower) + F.lit(float(upper) - lower) * share
        result = result.when((here >= rank) & (here > below), inside)
        lower, below = float(upper), here
    return result.otherwise(F.lit(lower))  # the rank is in the infinite bucket


def histogram_quantiles(
    events: DataFrame,
    value: str,
    bounds: Sequence[float],
    quantiles: Mapping[str, float],
    ts: str | None = None,
    width: str | None = None,
    slide: str | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Quantiles estimated from bucket counts, per window and label set."""
    keys: list = [*by]
    if ts and width:
        keys = [_window(ts, width, slide).alias("w"), *by]
    counts = events.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        *_bound_counts(value, bounds), F.count(F.lit(1)).alias("total")
    )
    start = [F.col("w.start").alias("window_start")] if ts and width else []
    return counts.select(
        *start,
        *by,
        F.col("total").alias("n"),
        *[_quantile(q, bounds).alias(name) for name, q in quantiles.items()],
    )


def gauges_of_cycles(cycles: DataFrame, gauges: Sequence[str], by: str, ts: str) -> DataFrame:
    """Long form (by, ts, gauge, value) of the numeric columns of a cycle table."""
    wide = cycles.select(by, ts, *[F.col(g).cast("double").alias(g) for g in gauges])
    return wide.unpivot([by, ts], list(gauges), "gauge", "value")


def latest_gauges(samples: DataFrame, by: Sequence[str], ts: str = "ts") -> DataFrame:
    """Last non-NULL value of each gauge."""
    return samples.where("value IS NOT NULL").groupBy(*by, "gauge").agg(
        F.max(F.struct(F.col(ts).alias("at"), F.col("value").alias("value"))).alias("last")
    ).select(*by, "gauge", F.col("last.value").alias("value"), F.col("last.at").alias("at"))


@dataclass(frozen=True)
class AlertRule:
    """``metric <op> bound`` that must hold for ``hold_seconds`` before it fires."""

    name: str
    metric: str
    op: str
    bound: float
    hold_seconds: int = 0
    severity: str = "warning"


# The alerts of the monitored service and of its models.
ALERT_RULES = (
    AlertRule("api_down", "up", "==", 0.0, 60, "critical"),
    AlertRule("model_not_loaded", "model_loaded", "==", 0.0, 120, "critical"),
    AlertRule("high_error_rate", "error_ratio", ">", 0.05, 300),
    AlertRule("high_latency", "latency_p95", ">", 0.5, 300),
    AlertRule("prediction_log_failing", "log_errors_increase", ">", 0.0),
    AlertRule("data_drift", "dataset_drift", "==", 1.0),
    AlertRule("live_roc_auc_low", "live_roc_auc", "<", 0.75),
    AlertRule("monitor_stale", "monitor_age_seconds", ">", 600.0),
)


def _breached(rule: AlertRule) -> Column:
    value, bound = F.col("value"), F.lit(rule.bound)
    tests = {">": value > bound, "<": value < bound, "==": value == bound}
    # NaN compares above every number in Spark; a missing measurement never alerts.
    return F.coalesce(tests[rule.op] & ~F.isnan(value), F.lit(False))


def alert_states(
    samples: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES, by: Sequence[str] = ()
) -> DataFrame:
    """State of each rule at each sample: inactive, pending or firing.

    ``samples`` is (by, metric, ts, value). A rule is pending from the first sample of an
    unbroken run of breaches and firing once the run has lasted ``hold_seconds``.
    """
    matches = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col("metric") == r.metric,
                    F.struct(
                        F.lit(r.name).alias("alert"),
                        F.lit(r.severity).alias("severity"),
                        F.lit(r.hold_seconds).alias("hold"),
                        _breached(r).alias("breached"),
                    ),
                )
                for r in rules
            ]
        )
    )
    tested = samples.where(F.col("metric").isin(*{r.metric for r in rules})).select(
        *by, "ts", "value", F.inline(matches)
    )
    keys = [*by, "alert"]
    runs = run_lengths(tested, keys, "ts", F.col("breached"), ~F.col("breached"))
    held = F.timestamp_diff("SECOND", F.col("run_since"), F.col("ts").cast("timestamp"))
    state = (
        F.when(~F.col("breached"), "inactive").when(held >= F.col("hold"), "firing").otherwise("pending")
    )
    return runs.select(*keys, "severity", "ts", "value", state.alias("state"))


def counter_increase(
    samples: DataFrame, ts: str, value: str, width: str, slide: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """(window_start, *by, increase): how much a counter grew in each trailing range.

    A sample below the one before it is a counter that started again, and counts in full.
    """
    stepped = previous_values(samples, by, ts, value)
    grown = F.when(F.col(value) >= F.col("previous"), F.col(value) - F.col("previous")).when(
        F.col("previous").isNotNull(), F.col(value)
    )
    return (
        stepped.withColumn("_grown", F.coalesce(grown, F.lit(0)).cast("double"))
        .groupBy(_window(ts, width, slide).alias("w"), *by)
        .agg(F.sum("_grown").alias("increase"))
        .select(F.col("w.start").alias("window_start"), *by, "increase")
    )


def presence(
    samples: DataFrame, ts: str, step: str, metric: str, by: Sequence[str] = (), until: Column | None = None
) -> DataFrame:
    """(*by, metric, ts, value): 1 for every step of time in which a key has samples, else 0.

    Steps go from a key's first sample to the last of all keys, or to ``until``; their number
    depends on the time covered alone.
    """
    length = F.expr(f"INTERVAL {step}")
    held = samples.groupBy(F.window(ts, step).start.alias("at"), *by).agg(F.lit(1.0).alias("value"))
    last = until if until is not None else held.agg(F.max("at")).scalar()
    keyed = held.select(F.col("at"), F.struct(*by, F.lit(0).alias("_")).alias("_g"), "value")
    steps = keyed.groupBy("_g").agg(F.min("at").alias("first")).select(
        "_g", F.explode(F.sequence(F.col("first"), last, length)).alias("at")
    )
    return steps.join(keyed, ["_g", "at"], "left").select(
        *[F.col(f"_g.{c}").alias(c) for c in by],
        F.lit(metric).alias("metric"),
        F.col("at").alias("ts"),
        F.coalesce("value", F.lit(0.0)).alias("value"),
    )


def age_samples(samples: DataFrame, metric: str, now: Column, by: Sequence[str] = ()) -> DataFrame:
    """Seconds since the last sample, itself as a sample at ``now`` (stale and down rules)."""
    return samples.groupBy(*by).agg(F.max("ts").alias("last")).select(
        *by,
        F.lit(metric).alias("metric"),
        now.alias("ts"),
        F.timestamp_diff("SECOND", F.col("last"), now).cast("double").alias("value"),
    )
