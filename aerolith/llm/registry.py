"""Queries and SQL of the training-data operators."""

from __future__ import annotations

import importlib

MODULES = ["quality_rules", "sharding", "quality_classifier", "simhash_dedup", "decontamination", "substring_exact", "toxicity", "substring_dedup", "packing", "language_id", "whitening", "html_extraction", "merkle_manifest"]


def _load() -> tuple[dict, dict]:
    queries, sql = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"aerolith.llm.{m}")
        queries.update(mod.QUERIES)
        sql.update(mod.SQL)
    return queries, sql


def queries() -> dict:
    return _load()[0]


def oracle_sql() -> dict:
    return _load()[1]
