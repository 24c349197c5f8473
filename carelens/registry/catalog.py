"""The list of queries; modules add to it at import."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from carelens.registry.views import Data, with_views

Build = Callable[[Data], DataFrame]

BUILDS: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; `sql` is the same result as DuckDB computes it."""

    def add(build: Build) -> Build:
        if name in BUILDS:
            raise ValueError(f"query {name!r} registered twice")
        BUILDS[name] = build
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return add
