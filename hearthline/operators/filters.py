"""Row filters. Each is one predicate, so Catalyst merges and pushes them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.geo import in_box
from hearthline.functions.html import page_ready


def _is(column: str, value: str) -> Column:
    # Null-safe: a null is not the sentinel and stays.
    return F.col(f"`{column}`").eqNullSafe(F.lit(value))


def drop_sentinel_title(df: DataFrame, column: str = "Title") -> DataFrame:
    return df.filter(~_is(column, S.TITLE_MISSING))


def rejected_titles(df: DataFrame, column: str = "Title") -> DataFrame:
    """The complement of ``drop_sentinel_title``."""
    return df.filter(_is(column, S.TITLE_MISSING))


def drop_unlisted_address(df: DataFrame, column: str = "full_address", keep_unlisted: bool = False) -> DataFrame:
    """Rows with a listed address; the daily load keeps the others as well."""
    return df if keep_unlisted else df.filter(~_is(column, S.ADDRESS_MISSING))


def drop_null_sqft(df: DataFrame, column: str = "square_feet") -> DataFrame:
    return df.dropna(subset=[column])


def bbox_filter(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    box: tuple[float, float, float, float] = S.MAP_BOX,
) -> DataFrame:
    return df.filter(in_box(F.col(lat), F.col(lon), box))


def conjunctive_filter(df: DataFrame, *conditions: Column) -> DataFrame:
    for condition in conditions:
        df = df.filter(condition)
    return df


def page_ready_filter(pages: DataFrame, marker: str, column: str = "html") -> DataFrame:
    return pages.filter(page_ready(F.col(column), marker))
