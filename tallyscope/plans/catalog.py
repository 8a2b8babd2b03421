"""All registered queries."""

from tallyscope.plans import base_queries, clique_queries, estimate_queries, model_queries, month_queries  # noqa: F401
from tallyscope.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
