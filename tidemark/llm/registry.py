"""The queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from importlib import import_module

MODULES = ("capping", "boilerplate", "residue", "spelling", "history", "truncation", "tokens", "mixing", "splitting")


def queries() -> dict:
    return {name: f for m in MODULES for name, f in import_module(f"tidemark.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in import_module(f"tidemark.llm.{m}").SQL.items()}
