"""Queries over the prediction log and its late feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import decisions, metrics, predictionlog, sampling, timeseries
from workload.registry import query, tidy, u
from workload.scores import _metrics_cte
from workload.views import frame, frames, with_clause

LOG = with_clause("prediction_log")
BATCH = with_clause("incoming_batch")
FED = with_clause("prediction_log", "feedback")
LABELED = f"""{FED}, last AS (SELECT prediction_id, actual, feedback_at FROM (SELECT *, row_number() OVER (
  PARTITION BY prediction_id ORDER BY feedback_at DESC, actual DESC) AS rn FROM feedback) WHERE rn = 1),
labeled AS (SELECT p.*, f.actual, f.feedback_at FROM prediction_log p LEFT JOIN last f USING (prediction_id))"""


def labeled_log(spark: SparkSession, sf: str) -> DataFrame:
    return predictionlog.attach_feedback(*frames(spark, sf, "prediction_log", "feedback"))


@query(
    "log_dedup",
    f"""{BATCH}, b AS (SELECT prediction_id, count(*) AS n_in_batch FROM incoming_batch GROUP BY 1),
l AS (SELECT prediction_id FROM prediction_log WHERE model_version = '1')
SELECT prediction_id, n_in_batch, prediction_id IN (SELECT prediction_id FROM l) AS already_logged FROM b
WHERE n_in_batch > 1 OR prediction_id IN (SELECT prediction_id FROM l)""",
)
def log_dedup(spark: SparkSession, sf: str) -> DataFrame:
    batch, log = frames(spark, sf, "incoming_batch", "prediction_log")
    return predictionlog.conflicting_ids(batch, log.where("model_version = '1'"))


@query(
    "log_first_rows",
    f"""{BATCH} SELECT prediction_id, created_at, model_version, round(churn_probability, 6) AS churn_probability
FROM (SELECT *, row_number() OVER (PARTITION BY prediction_id ORDER BY created_at) AS rn FROM incoming_batch) WHERE rn = 1""",
)
def log_first_rows(spark: SparkSession, sf: str) -> DataFrame:
    batch = frame(spark, sf, "incoming_batch").select(
        "prediction_id", "created_at", "model_version", "churn_probability"
    )
    return tidy(predictionlog.first_of_each_id(batch))


@query(
    "attach_feedback",
    f"""{LABELED} SELECT prediction_id, model_version, churn_prediction, coalesce(actual, -1) AS actual, feedback_at FROM labeled""",
)
def attach_feedback(spark: SparkSession, sf: str) -> DataFrame:
    labeled = labeled_log(spark, sf)
    return labeled.select(
        "prediction_id",
        "model_version",
        "churn_prediction",
        F.coalesce("actual", F.lit(-1)).alias("actual"),
        "feedback_at",
    )


@query(
    "orphan_feedback",
    f"{FED} SELECT prediction_id, actual, feedback_at FROM feedback WHERE prediction_id NOT IN (SELECT prediction_id FROM prediction_log)",
)
def orphan_feedback(spark: SparkSession, sf: str) -> DataFrame:
    return predictionlog.orphan_feedback(*frames(spark, sf, "prediction_log", "feedback"))


@query(
    "known_feedback",
    f"{FED} SELECT prediction_id, actual, feedback_at FROM feedback WHERE prediction_id IN (SELECT prediction_id FROM prediction_log)",
)
def known_feedback(spark: SparkSession, sf: str) -> DataFrame:
    return predictionlog.known_feedback(*frames(spark, sf, "prediction_log", "feedback"))


@query(
    "recent_window",
    f"""{LOG} SELECT prediction_id, created_at, model_version, CAST(json_extract(features, '$.k') AS INT) AS k,
  round(churn_probability, 6) AS churn_probability FROM prediction_log ORDER BY created_at DESC, prediction_id DESC LIMIT 1000""",
)
def recent_window(spark: SparkSession, sf: str) -> DataFrame:
    recent = predictionlog.most_recent(frame(spark, sf, "prediction_log"), 1000)
    parsed = recent.withColumn("f", F.from_json("features", "k int"))
    return tidy(parsed.select("prediction_id", "created_at", "model_version", "f.k", "churn_probability"))


@query(
    "labeled_recent",
    f"""{LABELED} SELECT prediction_id, created_at, actual, round(churn_probability, 6) AS churn_probability
FROM labeled WHERE actual IS NOT NULL ORDER BY created_at DESC, prediction_id DESC LIMIT 1000""",
)
def labeled_recent(spark: SparkSession, sf: str) -> DataFrame:
    recent = predictionlog.most_recent(labeled_log(spark, sf), 1000, labeled_only=True)
    return tidy(recent.select("prediction_id", "created_at", "actual", "churn_probability"))


@query("log_counts", f"{LABELED} SELECT count(*) AS total, count(actual) AS labeled FROM labeled")
def log_counts(spark: SparkSession, sf: str) -> DataFrame:
    return predictionlog.log_counts(labeled_log(spark, sf))


LIVE = ["roc_auc", "f1", "precision", "recall", "accuracy", "average_precision", "log_loss", "brier_score", "positive_rate"]


@query(
    "live_performance",
    f"""{LABELED}, src AS (SELECT churn_probability AS p, actual AS y FROM labeled WHERE model_version = '2'),
{_metrics_cte('src', [])}
SELECT CAST(n_samples AS BIGINT) AS n_labeled, {', '.join(f'round({m}, 6) AS {m}' for m in LIVE)},
  CASE WHEN roc_auc < 0.75 THEN 'roc_auc' ELSE '' END AS below FROM m""",
)
def live_performance(spark: SparkSession, sf: str) -> DataFrame:
    found = decisions.live_performance(labeled_log(spark, sf), "2")
    return tidy(found.select("n_labeled", *LIVE, "below"))


@query(
    "time_holdout",
    f"""{LABELED}, r AS (SELECT *, row_number() OVER (ORDER BY created_at DESC, {u('holdout', 'prediction_id')}, prediction_id) AS rn,
  count(*) OVER () AS n FROM labeled WHERE actual IS NOT NULL)
SELECT prediction_id, created_at, actual, CASE WHEN rn <= greatest(1, round_even(n * 0.25, 0)) THEN 'holdout' ELSE 'train' END AS part FROM r""",
)
def time_holdout(spark: SparkSession, sf: str) -> DataFrame:
    labeled = labeled_log(spark, sf).where("actual IS NOT NULL")
    return sampling.time_holdout(labeled.select("prediction_id", "created_at", "actual"))


CUSTOMERS = with_clause("customer_features")


@query(
    "json_features",
    f"""{CUSTOMERS} SELECT customer_id, tenure_months, monthly_charges, total_charges, num_support_tickets, avg_monthly_gb,
  senior_citizen, paperless_billing, has_tech_support, contract_type, internet_service, payment_method, 11 AS n_keys
FROM customer_features""",
)
def json_features(spark: SparkSession, sf: str) -> DataFrame:
    """Encode to JSON text, decode again, and count the keys of the text."""
    customers = frame(spark, sf, "customer_features")
    encoded = customers.select("customer_id", predictionlog.encode_features().alias("features"))
    keyed = encoded.withColumn("n_keys", F.size(F.json_object_keys("features")))
    return predictionlog.decode_features(keyed)


@query(
    "feedback_sampling",
    f"""{LOG} SELECT prediction_id, model_version FROM prediction_log WHERE {u('feedback', 'prediction_id')} < 0.3""",
)
def feedback_sampling(spark: SparkSession, sf: str) -> DataFrame:
    log = frame(spark, sf, "prediction_log").select("prediction_id", "model_version")
    return sampling.bernoulli_sample(log, "prediction_id", 0.3, "feedback")


@query(
    "client_summary",
    f"""{LABELED}, src AS (SELECT churn_probability AS p, actual AS y FROM labeled), {_metrics_cte('src', [])}
SELECT count(*) AS n, round(avg(actual), 6) AS true_rate, round(avg(churn_probability), 6) AS mean_probability,
  string_agg(DISTINCT model_version, ',' ORDER BY model_version) AS model_versions, round(any_value(m.roc_auc), 6) AS roc_auc
FROM labeled, m""",
)
def client_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(metrics.client_summary(labeled_log(spark, sf), "churn_probability", "actual", "model_version"))


@query(
    "score_trend",
    f"""{LOG} SELECT time_bucket(INTERVAL '1 day', created_at, TIMESTAMP '1970-01-01') AS window_start, count(*) AS n,
  round(avg(churn_prediction), 6) AS positive_share, round(avg(churn_probability), 6) AS mean_probability FROM prediction_log GROUP BY 1""",
)
def score_trend(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(timeseries.score_trend(frame(spark, sf, "prediction_log"), "created_at", "1 day"))


def histogram_sql(source: str, value: str, bounds: tuple[float, ...], by: str) -> str:
    rows = [
        f"SELECT {by}, '{b}' AS le, count(*) FILTER (WHERE {value} <= {b}) AS n, round(sum({value}), 4) AS value_sum, count(*) AS value_count FROM {source} GROUP BY {by}"
        for b in bounds
    ]
    rows.append(
        f"SELECT {by}, '+Inf', count(*), round(sum({value}), 4), count(*) FROM {source} GROUP BY {by}"
    )
    return "\nUNION ALL\n".join(rows)


@query(
    "probability_histogram",
    f"{LOG} {histogram_sql('prediction_log', 'churn_probability', timeseries.PROBABILITY_BOUNDS, 'model_version')}",
)
def probability_histogram(spark: SparkSession, sf: str) -> DataFrame:
    log = frame(spark, sf, "prediction_log")
    found = timeseries.cumulative_histogram(
        log, "churn_probability", timeseries.PROBABILITY_BOUNDS, ["model_version"]
    )
    return tidy(found, 4)
