"""Registered queries (one per operator key) and their DuckDB oracle SQL."""

from __future__ import annotations

from .common import ORACLE, QUERIES


def load_all():
    """Import every query module so its registrations run."""
    from . import (cleanup_queries, lookup_queries, message_queries, records_queries,  # noqa: F401
                   research_queries, store_queries, stream_queries, text_queries)
    return QUERIES, ORACLE
