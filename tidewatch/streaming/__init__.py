"""Structured Streaming forms of the log, metric, drift and decision operators."""
