"""Registered queries over the given tables, with equivalent SQL where there is one."""

from __future__ import annotations

from corpusloom.catalog import job_queries, linear_queries, model_queries, text_queries, vector_queries

PARTS = (text_queries, model_queries, vector_queries, linear_queries, job_queries)


def queries() -> dict:
    """All queries by operator name."""
    return {name: q for part in PARTS for name, q in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL by operator name."""
    return {name: s for part in PARTS for name, s in part.SQL.items()}
