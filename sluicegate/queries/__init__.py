"""Registered queries: each runs library operators over whole given tables, with a SQL equivalent."""

from sluicegate.queries import landing_queries, quality_queries, table_queries, upkeep_queries  # noqa: F401
from sluicegate.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
