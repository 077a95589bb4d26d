"""All registered queries."""

from . import archive_queries, dedupe_queries, learn_queries, market_queries, quality_queries, score_queries, stream_queries, text_queries, view_queries  # noqa: F401
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
