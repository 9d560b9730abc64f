"""Runnable queries, each with its oracle SQL."""

from . import orders_plans, analytics_plans, search_plans, streaming_plans, history_plans, rollup_plans  # noqa: F401  (importing registers the queries)
from .catalog import QUERIES, Query

__all__ = ["QUERIES", "Query"]
