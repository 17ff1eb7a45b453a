"""All named queries. Importing the query modules registers them."""

from wayfare.plans import batch_queries, learning_queries, road_queries, stream_queries  # noqa: F401
from wayfare.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
