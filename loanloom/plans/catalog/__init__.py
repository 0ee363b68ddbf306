"""Registered queries with their oracle SQL."""

from loanloom.plans.catalog import (  # noqa: F401  (registration)
    exploring,
    feature_queries,
    model_queries,
    quality_queries,
    ranking_queries,
    source_queries,
    wide,
)
from loanloom.plans.catalog.base import REGISTRY

__all__ = ["REGISTRY"]
