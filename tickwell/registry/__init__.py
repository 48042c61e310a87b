"""Named queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from importlib import import_module

from pyspark.sql import DataFrame

from tickwell.binding import Tables, oracle_query

MODULES = [
    "relational", "cleaning", "control", "bars", "cross", "lake", "streams", "analyst",
]


@dataclass(frozen=True)
class Entry:
    build: Callable[[Tables], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def register(key: str, sql: str | None = None):
    """Register ``build(tables) -> DataFrame`` under ``key``."""
    def add(build):
        if key in ENTRIES:
            raise ValueError(f"duplicate query key {key}")
        ENTRIES[key] = Entry(build, oracle_query(sql) if sql else None)
        return build
    return add


def load_all() -> dict[str, Entry]:
    for name in MODULES:
        import_module(f"tickwell.registry.{name}")
    return ENTRIES
