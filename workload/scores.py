"""Classification metrics over scored documents with partial labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import metrics, sampling
from workload.registry import query, tidy, u
from workload.views import frame, with_clause

DOCS = with_clause("scored_docs")
SCORE, RIVAL, LABEL = "churn_probability", "challenger_probability", "actual"
FLOOR = "least(greatest({}, CAST(1e-7 AS DOUBLE)), 1 - CAST(1e-7 AS DOUBLE))"


def _metrics_cte(source: str, by: list[str], name: str = "m") -> str:
    """All metrics per group, from per-score counts and plain window sums."""
    keys = "".join(f"{c}, " for c in by)
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    group = f"GROUP BY {', '.join(by)}" if by else ""
    return f"""{name}_d AS (SELECT {keys}{FLOOR.format('p')} AS p, y FROM {source} WHERE y IS NOT NULL),
{name}_c AS (SELECT {keys}p, CAST(sum(y) AS DOUBLE) AS a, CAST(sum(1 - y) AS DOUBLE) AS b FROM {name}_d GROUP BY {keys}p),
{name}_w AS (SELECT *, sum(a) OVER ({part}) AS ta, sum(b) OVER ({part}) AS tb,
  coalesce(sum(a) OVER ({part} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ca,
  coalesce(sum(b) OVER ({part} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb FROM {name}_c),
{name}_s AS (SELECT {keys}max(ta) AS ta, max(tb) AS tb,
  sum(CASE WHEN p >= 0.35 THEN a ELSE 0 END) AS tp, sum(CASE WHEN p >= 0.35 THEN b ELSE 0 END) AS fp,
  sum(a * (cb + b / 2)) AS won, sum(a / ta * ((ta - ca) / (ta - ca + tb - cb))) AS ap,
  -sum(a * ln(p) + b * ln(1 - p)) AS nll, sum(a * (1 - p) * (1 - p) + b * p * p) AS sq FROM {name}_w {group}),
{name} AS (SELECT {keys}(tp + tb - fp) / (ta + tb) AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN ta = 0 THEN 0 ELSE tp / ta END AS recall,
  CASE WHEN tp + fp + ta = 0 THEN 0 ELSE 2 * tp / (tp + fp + ta) END AS f1,
  CASE WHEN ta * tb > 0 THEN won / (ta * tb) ELSE CAST('NaN' AS DOUBLE) END AS roc_auc,
  CASE WHEN ta * tb > 0 THEN ap ELSE CAST('NaN' AS DOUBLE) END AS average_precision,
  nll / (ta + tb) AS log_loss, sq / (ta + tb) AS brier_score, (tp + fp) / (ta + tb) AS positive_rate,
  ta + tb AS n_samples FROM {name}_s)"""


ALL = ", ".join(f"round({m}, 6) AS {m}" for m in metrics.METRICS)
PLAIN = f"{DOCS}, src AS (SELECT {SCORE} AS p, {LABEL} AS y FROM scored_docs), {_metrics_cte('src', [])}"


@query("classification_metrics", f"{PLAIN} SELECT {ALL} FROM m")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.binary_metrics(frame(spark, sf, "scored_docs"), SCORE, LABEL))


@query("roc_auc", f"{PLAIN} SELECT round(roc_auc, 8) AS roc_auc FROM m")
def roc_auc(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.roc_auc(frame(spark, sf, "scored_docs"), SCORE, LABEL), 8)


@query("average_precision", f"{PLAIN} SELECT round(average_precision, 8) AS average_precision FROM m")
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.average_precision(frame(spark, sf, "scored_docs"), SCORE, LABEL), 8)


@query(
    "classification_report",
    f"""{DOCS}, c AS (SELECT CAST(count(*) FILTER (WHERE {SCORE} >= 0.35 AND {LABEL} = 1) AS DOUBLE) AS tp,
  CAST(count(*) FILTER (WHERE {SCORE} >= 0.35 AND {LABEL} = 0) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE {SCORE} < 0.35 AND {LABEL} = 1) AS DOUBLE) AS fn,
  CAST(count(*) FILTER (WHERE {SCORE} < 0.35 AND {LABEL} = 0) AS DOUBLE) AS tn FROM scored_docs),
k AS (SELECT 'retained' AS label, tn / (tn + fn) AS pr, tn / (tn + fp) AS rc, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS s FROM c
  UNION ALL SELECT 'churned', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c)
SELECT label, round(pr, 6) AS precision, round(rc, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM k
UNION ALL SELECT 'accuracy', round((tp + tn) / (tp + fp + fn + tn), 6), round((tp + tn) / (tp + fp + fn + tn), 6),
  round((tp + tn) / (tp + fp + fn + tn), 6), CAST(tp + fp + fn + tn AS BIGINT) FROM c
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(rc), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', round(sum(pr * s) / sum(s), 6), round(sum(rc * s) / sum(s), 6), round(sum(f * s) / sum(s), 6),
  CAST(sum(s) AS BIGINT) FROM k""",
)
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.classification_report(frame(spark, sf, "scored_docs"), SCORE, LABEL))


@query(
    "roc_curve",
    f"""{PLAIN} SELECT round(p, 8) AS threshold, round((tb - cb) / tb, 8) AS fpr, round((ta - ca) / ta, 8) AS tpr FROM m_w
UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0, 0""",
)
def roc_curve(spark: SparkSession, sf: str) -> DataFrame:
    curve = metrics.roc_curve(frame(spark, sf, "scored_docs"), SCORE, LABEL)
    threshold = F.when(F.col("threshold") < 2, F.round("threshold", 8)).otherwise(F.col("threshold"))
    return curve.select(threshold.alias("threshold"), F.round("fpr", 8).alias("fpr"), F.round("tpr", 8).alias("tpr"))


@query(
    "pr_curve",
    f"""{PLAIN} SELECT round(p, 8) AS threshold, round((ta - ca) / ta, 8) AS recall,
  round((ta - ca) / (ta - ca + tb - cb), 8) AS precision FROM m_w UNION ALL SELECT NULL, 0, 1""",
)
def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.pr_curve(frame(spark, sf, "scored_docs"), SCORE, LABEL), 8)


@query(
    "champion_vs_challenger",
    f"""{DOCS}, src AS (SELECT 'champion' AS model, {SCORE} AS p, {LABEL} AS y FROM scored_docs
  UNION ALL SELECT 'challenger', {RIVAL}, {LABEL} FROM scored_docs), {_metrics_cte('src', ['model'])}
SELECT model, {ALL} FROM m""",
)
def champion_vs_challenger(spark: SparkSession, sf: str) -> DataFrame:
    docs = frame(spark, sf, "scored_docs")
    return tidy(metrics.compare_scores(docs, {"champion": SCORE, "challenger": RIVAL}, LABEL))


CV = ["roc_auc", "f1", "average_precision", "accuracy", "precision", "recall"]


@query(
    "cv_summary",
    f"""{DOCS}, f AS (SELECT *, ntile(5) OVER (PARTITION BY {LABEL} ORDER BY {u('42', 'doc_id')}, doc_id) - 1 AS fold
  FROM scored_docs WHERE {LABEL} IS NOT NULL),
src AS (SELECT 'short' AS model, fold, {SCORE} AS p, {LABEL} AS y FROM f
  UNION ALL SELECT 'long', fold, {RIVAL}, {LABEL} FROM f), {_metrics_cte('src', ['model', 'fold'])}
SELECT model, {', '.join(f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std" for m in CV)} FROM m GROUP BY model""",
)
def cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    labeled = frame(spark, sf, "scored_docs").where(F.col(LABEL).isNotNull())
    folded = sampling.stratified_folds(labeled, "doc_id", LABEL)
    long = folded.select(
        "fold",
        F.col(LABEL).alias("y"),
        F.expr(f"stack(2, 'short', {SCORE}, 'long', {RIVAL}) AS (model, p)"),
    )
    per_fold = metrics.binary_metrics(long, "p", "y", by=["model", "fold"])
    return tidy(metrics.summarize_folds(per_fold, "model", CV))
