"""Spark operators for building and judging tabular credit-risk models."""

__version__ = "0.1.0"
