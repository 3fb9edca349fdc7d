"""All queries over the driver's tables, with the SQL that checks them."""

from __future__ import annotations

import importlib

MODULES: tuple[str, ...] = ("plans.text_queries", "plans.table_queries", "plans.sequence_queries", "plans.store_queries", "plans.vector_queries")


def _merged(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(importlib.import_module(f"evidra.{name}"), attribute)
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _merged("ORACLE_SQL")
