"""Registered queries (``QUERIES``) and their DuckDB oracle SQL (``ORACLE``)."""
from __future__ import annotations

import importlib

_MODULES = ["url_queries", "eda_queries", "encode_queries", "metric_queries", "explain_queries", "model_queries", "stream_queries"]


def _collect():
    queries, oracle = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(f"{__name__}.{name}")
        queries.update(mod.QUERIES)
        oracle.update(getattr(mod, "ORACLE", {}))
    return queries, oracle


def all_queries():
    return _collect()[0]


def all_oracle_sql():
    return _collect()[1]
