"""Exact binary-classification metrics, reports and curves.

Everything starts from one table of (score, positives, negatives) per distinct score: a
single scan with map-side combining yields thresholded, probabilistic and ranking metrics.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import clip_probability, drop_nan, safe_ratio
from tidewatch.operators.ordering import running_totals

METRICS = (
    "accuracy",
    "precision",
    "recall",
    "f1",
    "roc_auc",
    "average_precision",
    "log_loss",
    "brier_score",
    "positive_rate",
    "n_samples",
)
NAN = float("nan")


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct clipped score. Rows without a label or with a NaN score are left out."""
    labeled = df.where(F.col(label).isNotNull() & drop_nan(score).isNotNull())
    return (
        labeled.select(*by, clip_probability(score).alias("p"), F.col(label).cast("int").alias("y"))
        .groupBy(*by, "p")
        .agg(F.sum("y").cast("long").alias("pos"), F.sum(1 - F.col("y")).cast("long").alias("neg"))
    )


def _roc_auc() -> Column:
    pairs = F.max("pos_all").cast("double") * F.max("neg_all")
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2.0))
    return F.when(pairs > 0, F.try_divide(won, pairs)).otherwise(F.lit(NAN))


def _average_precision() -> Column:
    """Step sum of recall gain x precision, taken at each distinct score from the top down."""
    hits = F.col("pos_all") - F.col("pos_before")
    flagged = hits + F.col("neg_all") - F.col("neg_before")
    steps = F.sum(F.try_divide(F.col("pos"), F.col("pos_all")) * F.try_divide(hits, flagged))
    both = (F.max("pos_all") > 0) & (F.max("neg_all") > 0)
    return F.when(both, steps).otherwise(F.lit(NAN))


def roc_auc(
    df: DataFrame, score: str, label: str, by: Sequence[str] = (), like: DataFrame | None = None
) -> DataFrame:
    """ROC-AUC per group. ``like`` is a smaller table with scores of about the same range."""
    order = score_counts(like, score, label) if like is not None else None
    ranked = running_totals(score_counts(df, score, label, by), "p", ["pos", "neg"], by, like=order)
    return ranked.groupBy(*by).agg(_roc_auc().alias("roc_auc"))


def average_precision(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    ranked = running_totals(score_counts(df, score, label, by), "p", ["pos", "neg"], by)
    return ranked.groupBy(*by).agg(_average_precision().alias("average_precision"))


def _confusion(threshold: float) -> list[Column]:
    flagged = F.col("p") >= F.lit(float(threshold))
    return [
        F.sum(F.when(flagged, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(flagged, F.col("neg")).otherwise(0)).alias("fp"),
        F.sum(F.when(flagged, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(flagged, 0).otherwise(F.col("neg"))).alias("tn"),
    ]


def confusion_counts(
    df: DataFrame, score: str, label: str, threshold: float, by: Sequence[str] = ()
) -> DataFrame:
    """tp, fp, fn, tn at a threshold: one conditional-sum pass, no shuffle on the score."""
    labeled = df.where(F.col(label).isNotNull() & drop_nan(score).isNotNull()).select(
        *by,
        clip_probability(score).alias("p"),
        F.col(label).cast("long").alias("pos"),
        (1 - F.col(label).cast("long")).alias("neg"),
    )
    return labeled.groupBy(*by).agg(*_confusion(threshold))


def _thresholded(n: Column) -> dict[str, Column]:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return {
        "accuracy": (tp + F.col("tn")) / n,
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
    }


def binary_metrics(
    df: DataFrame,
    score: str,
    label: str,
    threshold: float = 0.35,
    by: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """All ten metrics in one row per group; ranking metrics are NaN when one class is absent."""
    ranked = running_totals(score_counts(df, score, label, by), "p", ["pos", "neg"], by, slices)
    pos, neg, p = F.col("pos"), F.col("neg"), F.col("p")
    sums = ranked.groupBy(*by).agg(
        *_confusion(threshold),
        F.sum(pos + neg).alias("n"),
        _roc_auc().alias("roc_auc"),
        _average_precision().alias("average_precision"),
        (-F.sum(pos * F.ln(p) + neg * F.ln(1 - p))).alias("nll"),
        F.sum(pos * (1 - p) * (1 - p) + neg * p * p).alias("sq"),
    )
    n = F.col("n")
    parts = _thresholded(n) | {
        "roc_auc": F.col("roc_auc"),
        "average_precision": F.col("average_precision"),
        "log_loss": F.col("nll") / n,
        "brier_score": F.col("sq") / n,
        "positive_rate": (F.col("tp") + F.col("fp")) / n,
        "n_samples": n.cast("double"),
    }
    return sums.select(*by, *[parts[m].cast("double").alias(m) for m in METRICS])


def compare_scores(
    df: DataFrame, scores: Mapping[str, str], label: str, threshold: float = 0.35
) -> DataFrame:
    """Metrics of several models on the same rows: ``scores`` maps model name to column."""
    pairs = ", ".join(f"'{name}', CAST(`{col}` AS DOUBLE)" for name, col in scores.items())
    long = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("_y"), F.expr(f"stack({len(scores)}, {pairs}) AS (model, _p)")
    )
    return binary_metrics(long, "_p", "_y", threshold, by=["model"])


def classification_report(
    df: DataFrame,
    score: str,
    label: str,
    threshold: float = 0.35,
    names: tuple[str, str] = ("retained", "churned"),
) -> DataFrame:
    """Per-class precision, recall, f1 and support with macro and weighted averages."""
    counts = confusion_counts(df, score, label, threshold)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def one_class(name: str, hit: Column, wrong: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            safe_ratio(hit, hit + wrong).alias("precision"),
            safe_ratio(hit, hit + missed).alias("recall"),
            safe_ratio(2 * hit, 2 * hit + wrong + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    classes = counts.select(
        one_class(names[0], tn, fn, fp).alias("a"),
        one_class(names[1], tp, fp, fn).alias("b"),
        safe_ratio(tp + tn, tp + fp + fn + tn).alias("acc"),
    )
    a, b = F.col("a"), F.col("b")
    total = a["support"] + b["support"]

    def average(name: str, mix) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            *[mix(m).alias(m) for m in ("precision", "recall", "f1")],
            total.alias("support"),
        )

    accuracy = F.struct(
        F.lit("accuracy").alias("label"),
        *[F.col("acc").alias(m) for m in ("precision", "recall", "f1")],
        total.alias("support"),
    )
    rows = F.array(
        a,
        b,
        accuracy,
        average("macro avg", lambda m: (a[m] + b[m]) / 2.0),
        average(
            "weighted avg",
            lambda m: safe_ratio(a[m] * a["support"] + b[m] * b["support"], total),
        ),
    )
    return classes.select(F.inline(rows))


def roc_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, plus the origin at threshold +inf."""
    ranked = running_totals(score_counts(df, score, label, by), "p", ["pos", "neg"], by)
    points = ranked.select(
        *by,
        F.col("p").alias("threshold"),
        F.try_divide(F.col("neg_all") - F.col("neg_before"), F.col("neg_all")).alias("fpr"),
        F.try_divide(F.col("pos_all") - F.col("pos_before"), F.col("pos_all")).alias("tpr"),
        ((F.col("pos_before") == 0) & (F.col("neg_before") == 0)).alias("_lowest"),
    )
    origin = F.struct(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    here = F.struct("threshold", "fpr", "tpr")
    return points.select(
        *by,
        F.inline(F.when(F.col("_lowest"), F.array(here, origin)).otherwise(F.array(here))),
    )


def pr_curve(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(threshold, recall, precision) at every distinct score, plus the (0, 1) end point."""
    ranked = running_totals(score_counts(df, score, label, by), "p", ["pos", "neg"], by)
    hits = F.col("pos_all") - F.col("pos_before")
    flagged = hits + F.col("neg_all") - F.col("neg_before")
    points = ranked.select(
        *by,
        F.col("p").alias("threshold"),
        F.try_divide(hits, F.col("pos_all")).alias("recall"),
        F.try_divide(hits, flagged).alias("precision"),
        ((F.col("pos_before") == 0) & (F.col("neg_before") == 0)).alias("_lowest"),
    )
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(0.0).alias("recall"),
        F.lit(1.0).alias("precision"),
    )
    here = F.struct("threshold", "recall", "precision")
    return points.select(
        *by, F.inline(F.when(F.col("_lowest"), F.array(here, end)).otherwise(F.array(here)))
    )


def summarize_folds(
    fold_metrics: DataFrame, candidate: str, metrics: Sequence[str]
) -> DataFrame:
    """Mean and population standard deviation of each metric over the folds."""
    return fold_metrics.groupBy(candidate).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics],
        *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics],
    )


def best_candidate(summary: DataFrame, metric: str, ordinal: str) -> DataFrame:
    """The row with the largest mean metric; the earliest candidate wins a tie."""
    value = F.when(F.isnan(f"{metric}_mean"), None).otherwise(F.col(f"{metric}_mean"))
    everything = F.struct(*summary.columns)
    return summary.agg(
        F.max_by(everything, F.struct(value, -F.col(ordinal))).alias("best")
    ).select("best.*")


def client_summary(
    df: DataFrame, score: str, label: str, version: str, by: Sequence[str] = ()
) -> DataFrame:
    """What a client sees: volume, true rate, mean probability, ranking quality, versions.

    Versions are made distinct before they are collected, so the list is as long as the
    number of model versions, never as long as the traffic.
    """
    base = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(label).cast("double")).alias("true_rate"),
        F.avg(F.col(score)).alias("mean_probability"),
        F.array_sort(F.collect_set(F.col(version).cast("string"))).alias("model_versions"),
    )
    auc = roc_auc(df, score, label, by)
    if not by:
        return base.withColumn("roc_auc", auc.scalar())
    return base.join(auc, list(by), "left")
