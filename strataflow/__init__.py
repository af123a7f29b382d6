"""Layered table operators and run analytics for Spark."""

from strataflow import functions, operators, plans, sources, streaming

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
