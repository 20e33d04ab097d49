from . import feature_queries, graph_queries, source_queries, text_queries  # noqa: F401
from .base import QUERIES, Tables

__all__ = ["QUERIES", "Tables"]
