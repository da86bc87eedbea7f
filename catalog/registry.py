"""The list of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from catalog.tables import Tables


@dataclass(frozen=True)
class Case:
    name: str
    run: Callable[[Tables], DataFrame]
    sql: str | None


CASES: dict[str, Case] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function under its name, with its SQL check if there is one."""

    def register(run: Callable[[Tables], DataFrame]):
        key = name or run.__name__
        if key in CASES:
            raise ValueError(f"query {key} is registered twice")
        CASES[key] = Case(key, run, sql)
        return run

    return register
