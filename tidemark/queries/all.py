"""Importing this module registers every query."""

from tidemark.queries import (  # noqa: F401
    expression_queries,
    model_queries,
    quality_queries,
    run_queries,
    selection_queries,
    storage_queries,
)
from tidemark.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
