"""Catalogue of runnable queries with their SQL equivalents."""

from packwright.plans import case_queries, file_queries, table_queries, text_queries  # noqa: F401
from packwright.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
