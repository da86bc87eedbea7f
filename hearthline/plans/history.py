"""Merging a day's listings into the dated history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from hearthline.operators.projection import add_ingest_date, drop_columns
from hearthline.operators.rows import align_to_history, sort_by_date, union_history


def merge_history(history: DataFrame, today: DataFrame, day: dt.date, ordered: bool = False) -> DataFrame:
    """History plus today's rows, aligned to its columns and stamped.

    The order by date is for reading; a table is written clustered by day
    instead of globally sorted, so sorting is off unless asked for.
    """
    aligned = align_to_history(history, drop_columns(today, ["date_added"]))
    merged = union_history(history, add_ingest_date(aligned, day).select(*aligned.columns))
    return sort_by_date(merged) if ordered else merged
