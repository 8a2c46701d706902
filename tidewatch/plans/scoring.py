"""Scoring a table with a fitted pipeline, and turning scores into log rows."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.functions.columns import decide_class
from tidewatch.operators.predictionlog import encode_features
from tidewatch.plans.lifecycle import resolve
from tidewatch.sources.tables import Workspace


def with_probability(model: PipelineModel, df: DataFrame, name: str = "probability_1") -> DataFrame:
    """Add the unrounded probability of the positive class; the input columns are kept."""
    kept = [c for c in df.columns if c not in CHURN.features]
    originals = F.struct(*CHURN.features).alias("_row")
    scored = model.transform(df.select(*kept, *CHURN.features, originals))
    return scored.select(
        *[F.col(f"_row.{c}").alias(c) if c in CHURN.features else F.col(c) for c in df.columns],
        vector_to_array("probability")[1].alias(name),
    )


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.35) -> DataFrame:
    """Add ``churn_probability`` (6 decimals) and ``churn_prediction``.

    The class is decided on the unrounded probability.
    """
    scored = with_probability(model, df)
    p = F.col("probability_1")
    return scored.withColumns(
        {"churn_probability": F.bround(p, 6), "churn_prediction": decide_class(p, threshold)}
    ).drop("probability_1")


def score_output(scored: DataFrame) -> DataFrame:
    """Id (if present), probability and class."""
    names = [CHURN.key, "churn_probability", "churn_prediction"]
    return scored.select(*[c for c in names if c in scored.columns])


def load_model(spark: SparkSession, ws: Workspace, uri: str) -> tuple[PipelineModel, str, int, str | None]:
    """(model, name, version, run_id) of a registry URI."""
    row = resolve(spark, ws, uri)
    if row["version"] is None:
        return PipelineModel.load(uri), None, None, None
    path = ws.model_path(row["model_name"], row["version"])
    return PipelineModel.load(path), row["model_name"], row["version"], row["run_id"]


def to_log_rows(
    scored: DataFrame, model_name: str, version: int, created_at: Column, prediction_id: Column
) -> DataFrame:
    """Prediction-log rows of a scored table.

    ``prediction_id`` should be a function of the row (a digest, say), so that a replayed
    batch produces the ids it produced the first time.
    """
    return scored.select(
        prediction_id.alias("prediction_id"),
        created_at.alias("created_at"),
        F.lit(model_name).alias("model_name"),
        F.lit(str(version)).alias("model_version"),
        encode_features().alias("features"),
        "churn_probability",
        "churn_prediction",
    )
