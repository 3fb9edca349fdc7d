"""Every query of this subpackage and the SQL that checks it."""

from __future__ import annotations

import importlib

MODULES = ("quality", "chat", "toxicity", "bpe", "simhash", "topk", "pii", "warc", "mixing", "langid", "planes", "codebooks", "alignment")


def _merged(attribute: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(importlib.import_module(f"{__package__}.{name}"), attribute)
    return found


def queries() -> dict:
    return _merged("QUERIES")


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in _merged("ORACLE_SQL").items() if v}
