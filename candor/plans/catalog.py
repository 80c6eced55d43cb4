"""All registered queries."""

from candor.plans import gap_queries, message_queries, report_queries, scoring_queries, style_queries, table_queries, text_queries  # noqa: F401
from candor.plans.registry import QUERIES

__all__ = ["QUERIES"]
