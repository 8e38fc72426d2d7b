"""All registered queries."""

from shelfweave.plans import document_queries, incremental_queries, meta_queries, sync_queries, text_queries  # noqa: F401
from shelfweave.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
