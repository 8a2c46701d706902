"""The prediction log: batches, late labels and the newest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.contract import CHURN, Contract
from tidewatch.operators.selection import newest

LOG_SCHEMA = (
    "prediction_id string, created_at timestamp, model_name string, model_version string, "
    "features string, churn_probability double, churn_prediction int"
)
FEEDBACK_SCHEMA = "prediction_id string, actual int, feedback_at timestamp"


def conflicting_ids(batch: DataFrame, log: DataFrame) -> DataFrame:
    """Ids that make a batch unloadable: repeated in it, or already in the log.

    (prediction_id, n_in_batch, already_logged). The log is first cut to the ids of the batch,
    so its rows are neither sorted nor made distinct as a whole.
    """
    incoming = batch.groupBy("prediction_id").agg(F.count(F.lit(1)).alias("n_in_batch"))
    hits = log.select("prediction_id").join(incoming.select("prediction_id"), "prediction_id", "left_semi")
    known = hits.distinct().withColumn("already_logged", F.lit(True))
    return (
        incoming.join(known, "prediction_id", "left")
        .withColumn("already_logged", F.coalesce("already_logged", F.lit(False)))
        .where((F.col("n_in_batch") > 1) | F.col("already_logged"))
    )


def first_of_each_id(batch: DataFrame, order: Column | str = "created_at") -> DataFrame:
    """One row per prediction id, the earliest; partial aggregation instead of a window."""
    order = F.col(order) if isinstance(order, str) else order
    others = [c for c in batch.columns if c != "prediction_id"]
    kept = batch.groupBy("prediction_id").agg(
        F.min_by(F.struct(*others), F.struct(order, F.struct(*others))).alias("row")
    )
    return kept.select("prediction_id", *[F.col(f"row.{c}").alias(c) for c in others]).select(
        *batch.columns
    )


def latest_feedback(feedback: DataFrame) -> DataFrame:
    """Last label per prediction id; a tie in time is settled by the larger label."""
    return feedback.groupBy("prediction_id").agg(
        F.max(F.struct("feedback_at", "actual")).alias("last")
    ).select("prediction_id", "last.actual", "last.feedback_at")


def attach_feedback(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Left join of the last label; unlabeled predictions keep NULL."""
    return predictions.join(latest_feedback(feedback), "prediction_id", "left")


def orphan_feedback(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Feedback for ids that were never logged."""
    return feedback.join(predictions.select("prediction_id"), "prediction_id", "left_anti")


def known_feedback(predictions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Feedback whose id is in the log."""
    return feedback.join(predictions.select("prediction_id"), "prediction_id", "left_semi")


def most_recent(log: DataFrame, n: int, labeled_only: bool = False) -> DataFrame:
    """The newest ``n`` rows, oldest first. They are found by counting, see :func:`newest`."""
    rows = log.where("actual IS NOT NULL") if labeled_only else log
    day = "created_date" if "created_date" in log.columns else None
    return newest(rows, n, day=day).orderBy("created_at", "prediction_id")


def latest_labels(changes: DataFrame, others: list[str]) -> DataFrame:
    """One row per prediction id of rows that repeat it: that of the last label, if it has any."""
    rest = F.struct(*others, "actual", "feedback_at")
    last = changes.groupBy("prediction_id").agg(F.max_by(rest, F.struct("feedback_at", "actual")).alias("r"))
    return last.select("prediction_id", "r.*")


def log_counts(log: DataFrame) -> DataFrame:
    return log.agg(F.count(F.lit(1)).alias("total"), F.count("actual").alias("labeled"))


def payload(contract: Contract = CHURN) -> Column:
    """A row's features as a typed struct: booleans, whole numbers, doubles and text."""
    cells = []
    for field in contract.fields:
        if field.role == "binary":
            cells.append(F.col(field.name).cast("int").cast("boolean").alias(field.name))
        else:
            cells.append(F.col(field.name).cast(field.spark_type).alias(field.name))
    return F.struct(*cells)


def encode_features(contract: Contract = CHURN) -> Column:
    """Features as JSON text in contract types (binaries as 0/1), NULLs kept."""
    cells = [F.col(f.name).cast(f.spark_type).alias(f.name) for f in contract.fields]
    return F.to_json(F.struct(*cells), {"ignoreNullFields": "false"})


def decode_features(log: DataFrame, column: str = "features", contract: Contract = CHURN) -> DataFrame:
    """Replace the JSON column by one column per contract feature."""
    schema = contract.schema(with_key=False, with_target=False)
    parsed = log.withColumn("_f", F.from_json(column, schema))
    kept = [c for c in log.columns if c != column]
    return parsed.select(*kept, "_f.*")
