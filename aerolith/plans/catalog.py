"""Registry of named queries (Spark builders) and their DuckDB oracles."""

from __future__ import annotations

import importlib

MODULES = [
    "q_scalars", "q_features", "q_quality", "q_joins", "q_eda", "q_monitoring", "q_timeseries", "q_registry", "q_sources", "q_streaming", "q_ml", "q_attribution",
]


def _load():
    queries, sql = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"aerolith.plans.{m}")
        queries.update(mod.QUERIES)
        sql.update({k: v for k, v in mod.SQL.items() if k in mod.QUERIES})
    return queries, sql


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
