"""Promotion, monitoring status and retraining decisions as column logic over tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.metrics import binary_metrics
from tidewatch.operators.registry import (
    PROMOTED,
    REJECTED,
    TAG_CHALLENGER_SCORE,
    TAG_CHAMPION_SCORE,
    TAG_COMPARED_TO,
    TAG_DECISION,
    TAG_METRIC,
    TAG_REASON,
)
from tidewatch.operators.runs import run_lengths


@dataclass(frozen=True)
class PromotionPolicy:
    metric: str = "roc_auc"
    margin: float = 0.01
    minimums: Mapping[str, float] = field(default_factory=lambda: {"roc_auc": 0.75, "f1": 0.45})


@dataclass(frozen=True)
class MonitorPolicy:
    days: float | None = 7.0  # length of the window; None reads the whole log
    window: int | None = None  # newest rows of it; all unless set
    min_window: int = 200
    min_labeled: int = 100
    minimums: Mapping[str, float] = field(default_factory=lambda: {"roc_auc": 0.75})
    threshold: float = 0.35


@dataclass(frozen=True)
class RetrainPolicy:
    enabled: bool = True
    min_labeled: int = 500
    max_fresh: int = 1000  # newest labeled rows that a classifier is fitted and compared on
    holdout: float = 0.25
    min_training: int = 500
    cooldown_minutes: float = 30.0
    persistence: int = 2


def _real(value: Column) -> Column:
    """NaN to NULL: Spark orders NaN above every number, so it must never be compared."""
    return F.when(~F.isnan(value), value)


def promotion_gate(pairs: DataFrame, policy: PromotionPolicy = PromotionPolicy()) -> DataFrame:
    """Decide each (challenger, champion) pair of metric maps.

    Input columns ``challenger`` and ``champion`` are ``map<string,double>``; a NULL
    champion map means there is none. Adds promote, outcome, failed_gates, both scores
    and a reason text.
    """
    value = _real(F.try_element_at("challenger", F.lit(policy.metric)))
    rival = _real(F.try_element_at("champion", F.lit(policy.metric)))
    failed = F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.coalesce(
                        _real(F.try_element_at("challenger", F.lit(m))) >= F.lit(float(low)),
                        F.lit(False),
                    ),
                    F.lit(m),
                )
                for m, low in sorted(policy.minimums.items())
            ],
            F.lit(None).cast("string"),
        )
    )
    outcome = (
        F.when(F.size("failed_gates") > 0, F.lit("failed_gate"))
        .when(F.col("champion").isNull(), F.lit("no_champion"))
        .when(rival.isNull(), F.lit("champion_unscored"))
        .when(value >= rival + F.lit(policy.margin), F.lit("better"))
        .otherwise(F.lit("not_better"))
    )
    reason = (
        F.when(
            F.col("outcome") == "failed_gate",
            F.concat(F.lit("below the quality gate: "), F.concat_ws(", ", "failed_gates")),
        )
        .when(F.col("outcome") == "no_champion", F.lit("gates passed and there is no champion"))
        .when(
            F.col("outcome") == "champion_unscored",
            F.lit("gates passed and the champion has no score"),
        )
        .otherwise(
            F.format_string(
                f"{policy.metric} %.4f against %.4f + {policy.margin}",
                "challenger_score",
                "champion_score",
            )
        )
    )
    compared = F.col("outcome").isin("better", "not_better")
    return (
        pairs.withColumn("failed_gates", failed)
        .withColumn("outcome", outcome)
        .withColumn("challenger_score", value)
        .withColumn("champion_score", F.when(compared, rival))
        .withColumn("promote", F.col("outcome").isin("no_champion", "champion_unscored", "better"))
        .withColumn("reason", reason)
    )


def decision_tags(decided: DataFrame, metric: str, ts: Column) -> DataFrame:
    """Audit rows (model_name, version, key, value, event_ts) for decided pairs.

    Needs model_name, version and champion_version next to the gate's columns.
    """

    def entry(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    entries = F.array(
        entry(TAG_DECISION, F.when(F.col("promote"), PROMOTED).otherwise(REJECTED)),
        entry(TAG_REASON, F.col("reason")),
        entry(TAG_METRIC, F.lit(metric)),
        entry(
            TAG_CHALLENGER_SCORE,
            F.when(
                F.col("challenger_score").isNotNull(), F.format_string("%.6f", "challenger_score")
            ).otherwise("nan"),
        ),
        entry(
            TAG_CHAMPION_SCORE,
            F.when(F.col("champion_score").isNotNull(), F.format_string("%.6f", "champion_score")),
        ),
        entry(TAG_COMPARED_TO, F.col("champion_version").cast("string")),
    )
    return (
        decided.select("model_name", "version", F.inline(entries))
        .where("value IS NOT NULL")
        .withColumn("event_ts", ts)
    )


def live_performance(
    window: DataFrame,
    version: str | None = None,
    policy: MonitorPolicy = MonitorPolicy(),
    by: tuple[str, ...] = (),
    slices: int | None = None,
) -> DataFrame:
    """Metrics on the champion's labeled rows; NULL metrics when they would say nothing.

    Fewer rows than ``min_labeled`` or a single class gives only ``n_labeled``.
    ``below`` lists the metrics under their minimum.
    """
    rows = window.where("actual IS NOT NULL")
    if version is not None:
        rows = rows.where(F.col("model_version").cast("string") == str(version))
    scored = binary_metrics(rows, "churn_probability", "actual", policy.threshold, by, slices)
    names = [c for c in scored.columns if c not in by and c != "n_samples"]
    n = F.coalesce(F.col("n_samples"), F.lit(0.0)).cast("long")
    usable = (n >= policy.min_labeled) & ~F.isnan("roc_auc")
    below = F.array_compact(
        F.array(
            *[
                F.when(usable & (F.col(m) < F.lit(float(low))), F.lit(m))
                for m, low in sorted(policy.minimums.items())
            ],
            F.lit(None).cast("string"),
        )
    )
    return scored.select(
        *by,
        n.alias("n_labeled"),
        *[F.when(usable, F.col(m)).alias(m) for m in names],
        below.alias("below"),
    )


def cycle_status(
    cycles: DataFrame,
    policy: MonitorPolicy = MonitorPolicy(),
    share: float = 0.15,
) -> DataFrame:
    """Add status, retrain_reasons and triggered to one row per monitoring cycle.

    Needs model_version, run_id, window_size, drift_share, drifted_features and
    ``live`` (``map<string,double>`` of live metrics, NULL when not computed).
    """
    no_model = F.col("model_version").isNull() | F.col("run_id").isNull()
    too_small = F.col("window_size") < policy.min_window
    drifted = F.coalesce(F.col("drift_share") >= share, F.lit(False))
    under = []
    for metric, low in sorted(policy.minimums.items()):
        value = F.try_element_at("live", F.lit(metric))
        weak = F.coalesce(_real(value) < F.lit(float(low)), F.lit(False))
        under.append(F.when(weak, F.format_string(f"live {metric} %.4f < {low}", value)))
    degraded = F.lit(False)
    for reason in under:
        degraded = degraded | reason.isNotNull()
    reasons = F.array_compact(
        F.array(
            F.when(
                drifted,
                F.concat(
                    F.lit("drift in "),
                    F.size("drifted_features").cast("string"),
                    F.lit(" feature(s): "),
                    F.concat_ws(", ", "drifted_features"),
                ),
            ),
            *under,
        )
    )
    evaluated = ~no_model & ~too_small
    status = (
        F.when(no_model, "no_model")
        .when(too_small, "insufficient_data")
        .when(degraded, "degraded")
        .when(drifted, "drift")
        .otherwise("ok")
    )
    return (
        cycles.withColumn("status", status)
        .withColumn(
            "retrain_reasons",
            F.when(evaluated, reasons).otherwise(F.array().cast("array<string>")),
        )
        .withColumn("triggered", F.size("retrain_reasons") > 0)
    )


def debounce(
    cycles: DataFrame,
    required: int = 2,
    by: str = "model_name",
    ts: str = "cycle_ts",
    triggered: str = "triggered",
    evaluated: str | None = None,
    allow: str | None = None,
) -> DataFrame:
    """Add ``streak`` and ``fire``: true on every ``required``-th consecutive triggered cycle.

    Firing resets the streak, so within a run of triggered cycles it fires at positions
    N, 2N, ... Cycles that were not evaluated (``evaluated`` false) neither extend nor
    break a run. A cycle where retraining is not allowed counts as not triggered.
    """
    required = max(1, required)
    hit = F.coalesce(F.col(triggered), F.lit(False))
    if allow:
        hit = hit & F.coalesce(F.col(allow), F.lit(False))
    counted = F.coalesce(F.col(evaluated), F.lit(False)) if evaluated else F.lit(True)
    marked = cycles.withColumn("_hit", counted & hit)
    placed = run_lengths(marked, [by], ts, F.col("_hit"), counted & ~hit)
    streak = F.when(F.col("_hit"), (F.col("run_length") - 1) % required + 1).otherwise(0)
    fire = F.col("_hit") & (F.col("run_length") % required == 0)
    return placed.withColumn("streak", streak).withColumn("fire", fire).drop("_hit", "run_length", "run_since")


def retrain_guards(
    states: DataFrame, policy: RetrainPolicy = RetrainPolicy(), force: str | None = None
) -> DataFrame:
    """Add ``guard``: the first rule that stops a retraining, NULL when none does.

    Needs minutes_since_newest (NULL if no version exists), champion_version,
    champion_run_id and n_labeled. ``force`` names a boolean column that skips the first
    two rules.
    """
    forced = F.coalesce(F.col(force), F.lit(False)) if force else F.lit(False)
    guard = (
        F.when(~forced & F.lit(not policy.enabled), "disabled")
        .when(~forced & (F.col("minutes_since_newest") < policy.cooldown_minutes), "cooldown")
        .when(F.col("champion_version").isNull(), "no_champion")
        .when(F.col("champion_run_id").isNull(), "champion_without_run")
        .when(F.coalesce("n_labeled", F.lit(0)) < policy.min_labeled, "too_few_labels")
    )
    return states.withColumn("guard", guard)


ATTEMPT_SCHEMA = (
    "model_name string, at timestamp, trigger_reasons array<string>, guard string, streak long, required long, "
    "error string, promoted boolean, decision string, version int, champion_version int, "
    "challenger_score double, champion_score double, n_fresh_train long, n_reference long, n_holdout long"
)


def retrain_outcomes(attempts: DataFrame) -> DataFrame:
    """Add ``status`` and ``reason`` to the facts of retraining attempts.

    The facts are settled in the order in which an attempt meets them: a guard that stopped
    it, a streak that is still short of ``required``, an error of its run, then the gate's
    ``decision``. ``trigger`` tells attempts that a monitor asked for from all others.
    """
    waits = F.coalesce(F.col("streak") < F.col("required"), F.lit(False))
    streak = F.format_string("%d of %d consecutive triggered cycles", "streak", "required")
    stages = [
        (F.col("guard").isNotNull(), "skipped", F.col("guard")),
        (waits, "pending", streak),
        (F.col("error").isNotNull(), "failed", F.col("error")),
        (F.coalesce("promoted", F.lit(False)), "promoted", F.col("decision")),
    ]
    status, reason = F.lit("rejected"), F.col("decision")
    for applies, name, why in reversed(stages):
        status = F.when(applies, F.lit(name)).otherwise(status)
        reason = F.when(applies, why).otherwise(reason)
    asked = F.coalesce(F.size("trigger_reasons"), F.lit(0)) > 0
    return attempts.withColumns(
        {"status": status, "reason": reason, "trigger": F.when(asked, "monitoring").otherwise("manual")}
    )


def outcome_counts(outcomes: DataFrame, by: Sequence[str] = ("model_name",)) -> DataFrame:
    """Attempts per outcome, as long rows with the sizes of what was trained and held out."""
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("n_fresh_train", "n_reference", "n_holdout")]
    return outcomes.groupBy(*by, "status", "trigger").agg(F.count(F.lit(1)).alias("n"), *sums)
