"""Engineered features and the pipeline stages that feed a classifier.

All stages are column expressions over fitted numbers: no Python runs per row, and a
fitted stage is saved and loaded with the rest of an MLlib pipeline.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.operators.validation import coerce_types

ENGINEERED_NUMERIC = ["tickets_per_tenure_year", "charge_to_market_ratio"]
ENGINEERED_BINARY = ["is_new_customer"]
NUMERIC = CHURN.with_role("numeric") + ENGINEERED_NUMERIC
BINARY = CHURN.with_role("binary") + ENGINEERED_BINARY
CATEGORICAL = CHURN.with_role("categorical")


def engineered_names(inputs: list[str]) -> list[str]:
    return [*inputs, *ENGINEERED_NUMERIC, *ENGINEERED_BINARY]


def engineer(df: DataFrame, market_price: Column | float) -> DataFrame:
    """Add the engineered columns to a table with contract features.

    A missing total is tenure x monthly charge; a missing tenure is not a new customer.
    """
    typed = coerce_types(df)
    price = market_price if isinstance(market_price, Column) else F.lit(float(market_price))
    tenure, monthly = F.col("tenure_months"), F.col("monthly_charges")
    return typed.withColumns(
        {
            "total_charges": F.coalesce("total_charges", tenure * monthly),
            "tickets_per_tenure_year": F.try_divide(F.col("num_support_tickets"), tenure / 12.0 + 1.0),
            "charge_to_market_ratio": monthly / F.greatest(price, F.lit(1e-6)),
            "is_new_customer": F.coalesce(tenure < 6, F.lit(False)).cast("double"),
        }
    )


def select_features(df: DataFrame, with_target: bool = True) -> DataFrame:
    """Contract features (and the target as int); other columns are ignored."""
    columns = [F.col(c) for c in CHURN.features]
    if with_target:
        columns.append(F.col(CHURN.target).cast("int").alias(CHURN.target))
    return df.select(*columns)


class _FittedNumbers(Params):
    """Holds fitted numbers as one JSON parameter, so default persistence stores them."""

    fitted = Param(Params._dummy(), "fitted", "fitted numbers as JSON", TypeConverters.toString)

    def numbers(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))


class EngineeredFeatures(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median monthly charge and adds the engineered columns."""

    def _fit(self, dataset: DataFrame) -> EngineeredFeaturesModel:
        row = exact_quantiles(dataset, ["monthly_charges"], [0.5]).first()
        price = row["quantiles"][0] if row else 0.0
        return EngineeredFeaturesModel(fitted=json.dumps({"market_price": price}))


class EngineeredFeaturesModel(Model, _FittedNumbers, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, fitted: str = "{}") -> None:
        super().__init__()
        self._set(fitted=fitted)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return engineer(dataset, self.numbers()["market_price"])


def most_frequent(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, value) with the most frequent non-missing value; the smallest wins a tie."""
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    counts = (
        wide.unpivot([], columns, "feature", "value")
        .where("value IS NOT NULL")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value").alias("value")))
    return counts.groupBy("feature").agg(best.alias("b")).select("feature", "b.value")


class PreparedColumns(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Median / mode imputation, population standardisation and fixed-domain one-hot.

    Statistics are exact: MLlib's imputer takes a lower order statistic for an even count
    and its scaler divides by the sample deviation.
    """

    def _fit(self, dataset: DataFrame) -> PreparedColumnsModel:
        found = exact_quantiles(dataset, NUMERIC, [0.5]).collect()
        medians = {r["feature"]: r["quantiles"][0] for r in found}
        modes = {r["feature"]: r["value"] for r in most_frequent(dataset, BINARY + CATEGORICAL).collect()}
        filled = [F.coalesce(F.col(c), F.lit(medians.get(c, 0.0))) for c in NUMERIC]
        moments = dataset.agg(
            *[F.avg(x).alias(f"m{i}") for i, x in enumerate(filled)],
            *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)],
        ).first()
        scale = {
            c: [medians.get(c, 0.0), moments[f"m{i}"], moments[f"s{i}"] or 1.0]
            for i, c in enumerate(NUMERIC)
        }
        return PreparedColumnsModel(fitted=json.dumps({"numeric": scale, "modes": modes}))


class PreparedColumnsModel(Model, _FittedNumbers, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, fitted: str = "{}") -> None:
        super().__init__()
        self._set(fitted=fitted)

    @staticmethod
    def outputs() -> list[str]:
        hot = [f"{f.name}={v}" for f in CHURN.fields if f.role == "categorical" for v in f.domain]
        return [f"x_{c}" for c in [*NUMERIC, *BINARY, *hot]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numbers = self.numbers()
        cells = []
        for name in NUMERIC:
            median, mean, deviation = numbers["numeric"][name]
            filled = F.coalesce(F.col(name), F.lit(median))
            cells.append(((filled - F.lit(mean)) / F.lit(deviation)).alias(f"x_{name}"))
        for name in BINARY:
            mode = float(numbers["modes"].get(name, 0.0))
            cells.append(F.coalesce(F.col(name).cast("double"), F.lit(mode)).alias(f"x_{name}"))
        for field in CHURN.fields:
            if field.role == "categorical":
                mode = numbers["modes"].get(field.name, field.domain[0])
                filled = F.coalesce(F.col(field.name), F.lit(mode))
                cells += [
                    (filled == v).cast("double").alias(f"x_{field.name}={v}") for v in field.domain
                ]
        return dataset.select("*", *cells)


def preparation_stages() -> list:
    """Everything before the classifier; 21 inputs in a fixed order."""
    assembler = VectorAssembler(inputCols=PreparedColumnsModel.outputs(), outputCol="inputs")
    return [EngineeredFeatures(), PreparedColumns(), assembler]


def build_pipeline(classifier) -> Pipeline:
    return Pipeline(stages=[*preparation_stages(), classifier])
