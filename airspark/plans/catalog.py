"""Registry of every implemented query: Spark callable + DuckDB oracle SQL.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
given tables (whole tables, no row caps).  ``ORACLE`` holds the equivalent
DuckDB SQL where one exists.  Double outputs are rounded to 1e-6 on both
sides with identical arithmetic so engine summation order cannot differ.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all():
    # Importing the query modules fills the registry.
    from . import q_core, q_eda, q_evaluation, q_ml, q_scoring, q_sources, q_stream  # noqa: F401
    return QUERIES, ORACLE
