"""Registered queries: each operator on the sample tables, with the SQL that must give the same rows."""

from playtide.catalog import ingest_queries, report_queries, rule_queries, serving_queries, stream_queries  # noqa: F401
from playtide.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
