"""The registered workload: views over the given tables, queries and their SQL oracles."""

from workload import customers, distributions, lifecycle, log, scores, streams, traffic
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "customers", "distributions", "lifecycle", "log", "scores", "streams", "traffic"]
