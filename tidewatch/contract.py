"""The feature contract, kept as data.

One tuple of fields drives the read schema, the validation checks, the feature
stages and the list of monitored columns, so they cannot disagree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One model input. ``lower``/``upper`` are inclusive, ``domain`` is for categoricals."""

    name: str
    role: str
    lower: float | None = None
    upper: float | None = None
    domain: tuple[str, ...] = ()
    optional: bool = False
    whole: bool = False

    @property
    def spark_type(self) -> T.DataType:
        if self.role == "categorical":
            return T.StringType()
        return T.IntegerType() if self.whole or self.role == "binary" else T.DoubleType()


@dataclass(frozen=True)
class Contract:
    """Id column, target column and the ordered model inputs."""

    key: str
    target: str
    fields: tuple[Field, ...]

    @property
    def features(self) -> list[str]:
        return [f.name for f in self.fields]

    def with_role(self, *roles: str) -> list[str]:
        return [f.name for f in self.fields if f.role in roles]

    def schema(self, with_key: bool = True, with_target: bool = True) -> T.StructType:
        columns = [T.StructField(f.name, f.spark_type) for f in self.fields]
        if with_key:
            columns.insert(0, T.StructField(self.key, T.StringType()))
        if with_target:
            columns.append(T.StructField(self.target, T.IntegerType()))
        return T.StructType(columns)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The contract as a table (one row per field), for joins and audit."""
        def bound(value: float | None) -> float | None:
            return None if value is None else float(value)

        rows = [
            (i, f.name, f.role, bound(f.lower), bound(f.upper), list(f.domain), f.optional)
            for i, f in enumerate(self.fields)
        ]
        return spark.createDataFrame(
            rows,
            "ordinal int, column string, role string, lower double, upper double, "
            "domain array<string>, optional boolean",
        )


# Names, ranges and domains every table in this library agrees on.
CHURN = Contract(
    key="customer_id",
    target="churned",
    fields=(
        Field("tenure_months", "numeric", 0, 120, whole=True),
        Field("monthly_charges", "numeric", 0, 500),
        Field("total_charges", "numeric", 0, 60000, optional=True),
        Field("num_support_tickets", "numeric", 0, 100, whole=True),
        Field("avg_monthly_gb", "numeric", 0, 5000, optional=True),
        Field("senior_citizen", "binary"),
        Field("paperless_billing", "binary"),
        Field("has_tech_support", "binary"),
        Field("contract_type", "categorical", domain=("month_to_month", "one_year", "two_year")),
        Field("internet_service", "categorical", domain=("dsl", "fiber_optic", "none")),
        Field(
            "payment_method",
            "categorical",
            domain=("electronic_check", "mailed_check", "bank_transfer", "credit_card"),
        ),
    ),
)
