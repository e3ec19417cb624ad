"""The queries of the core, by operator, and the SQL they are held against."""

from __future__ import annotations

from importlib import import_module

MODULES: tuple[str, ...] = ("timestamps", "scalars", "ranking", "filters", "state", "parsing", "streams", "more")
FLAGSHIP = "w_cap"


def queries() -> dict:
    return {name: f for m in MODULES for name, f in import_module(f"tidemark.plans.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in import_module(f"tidemark.plans.{m}").SQL.items()}
