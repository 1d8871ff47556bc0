"""Registry of bound queries: name -> (Spark builder, oracle SQL, operator ids)."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..tables import Tables


@dataclass(frozen=True)
class Binding:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    ops: tuple[str, ...] = field(default_factory=tuple)


REGISTRY: dict[str, Binding] = {}

_MODULES = ("core", "text_numbers", "keys_sets", "aggregates", "windows_reshape", "quality",
            "geo", "recipes", "planning", "sources", "views", "keychecks", "changes")


def register(name: str, sql: str | None, ops: tuple[str, ...] | list[str] = ()):
    def deco(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query name {name}")
        REGISTRY[name] = Binding(name, fn, sql.strip() if sql else None, tuple(ops))
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def make(b: Binding):
        return lambda spark, sf_dir: b.build(Tables(spark, sf_dir))
    return {name: make(b) for name, b in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: b.sql for name, b in REGISTRY.items() if b.sql}
