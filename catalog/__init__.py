"""Registered queries over the test tables, each with its SQL check.

A query is a function of :class:`catalog.tables.Tables`; the check is the same
question put in DuckDB SQL over the same Parquet tables.
"""

from __future__ import annotations

from catalog import aggregates, extraction, filters, geo, io, modelling, projections, rows, scalars, sources
from catalog.registry import CASES

MODULES = (sources, extraction, projections, filters, geo, aggregates, rows, scalars, modelling, io)

__all__ = ["CASES", "MODULES"]
