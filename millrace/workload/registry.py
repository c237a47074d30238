"""Registered queries: a Spark job, the inventory rows it shows, and SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    covers: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(covers: str, sql: str | None = None, name: str | None = None):
    """Decorator: ``covers`` lists inventory ids, ``sql`` is the check (none: rows only)."""

    def wrap(fn: Query) -> Query:
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"{key} is registered twice")
        REGISTRY[key] = Entry(fn, tuple(covers.split()), sql)
        return fn

    return wrap
