"""Registered queries over the test tables, each with its SQL counterpart."""

from __future__ import annotations

from importlib import import_module

from feedloom.checks import registry

_MODULES = ("rules", "ingest", "texts", "models", "streams")


def _load() -> None:
    for name in _MODULES:
        import_module(f"feedloom.checks.{name}")


def all_queries() -> dict[str, registry.Query]:
    _load()
    return dict(registry.QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
