"""Registered queries, each beside the SQL that an independent engine checks it with."""

from daybook.suite.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
