"""Registered queries: the library's operators over the given tables, each with its SQL."""

from importlib import import_module

MODULES = (
    "profiles",
    "collisions",
    "evidence",
    "redirects",
    "audits",
    "names",
    "publishing",
    "files",
)


def _entries() -> dict:
    found: dict = {}
    for module in MODULES:
        found.update(import_module(f"catalogue.{module}").QUERIES)
    return found


def all_queries() -> dict:
    return {name: query for name, (query, _) in _entries().items()}


def all_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _entries().items() if sql}
