"""Model monitoring and model-lifecycle analytics as Spark DataFrame operators."""

from tidewatch.contract import CHURN, Contract, Field

__all__ = ["CHURN", "Contract", "Field"]
