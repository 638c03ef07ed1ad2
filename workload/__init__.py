"""Queries over the given tables, each with the SQL it must agree with."""

from importlib import import_module

from .registry import QUERIES, SQL

MODULES = ["cleaning", "ads", "fraudwatch", "joining", "storage", "streams"]


def _load() -> None:
    for name in MODULES:
        import_module(f"{__name__}.{name}")


def all_queries() -> dict:
    _load()
    return dict(QUERIES)


def all_sql() -> dict:
    _load()
    return dict(SQL)
