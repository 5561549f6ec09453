"""Registry of every implemented query: name -> Spark callable, name -> DuckDB twin."""

from __future__ import annotations

import importlib

_MODULES = [
    "drift_q",
    "profile_q",
    "metrics_q",
    "audit_q",
    "health_q",
    "decisions_q",
    "similarity_q",
    "reporting_q",
    "features_q",
    "streams_q",
    "models_q",
    "sources_q",
]


def _load():
    queries, sql = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"{__name__}.{m}")
        queries.update(mod.QUERIES)
        sql.update(mod.SQL)
    return queries, sql


def all_queries():
    return _load()[0]


def all_sql():
    return _load()[1]
