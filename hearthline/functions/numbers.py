"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round2(value: Column) -> Column:
    """Two places, halves to even, as scaled binary arithmetic rounds them.

    ``bround`` rounds the decimal text of a double instead and differs on
    values such as 1.015.
    """
    return F.rint(value * 100) / 100
