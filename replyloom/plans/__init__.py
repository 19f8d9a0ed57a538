"""Registered queries by family."""

from replyloom.plans import (  # noqa: F401
    extract_queries, gate_queries, model_queries, prep_queries, reply_queries, route_queries,
)
from replyloom.plans.registry import CHECKS, QUERIES  # noqa: F401
