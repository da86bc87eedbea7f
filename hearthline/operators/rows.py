"""Deduplication, ordering and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.projection import fill_missing_columns, frame_from_rows, quoted, reorder_columns, schema_diff


def dedup_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows. Copies merge before the shuffle."""
    return df.dropDuplicates()


#: Repeated hashes whose rows are looked at in full at once.
_SUSPECTS = 1000


def has_duplicates(df: DataFrame) -> DataFrame:
    """One row saying whether any full row occurs twice.

    128-bit hashes of the rows are counted first, so only those travel. Rows
    under some of the repeated hashes, a bounded number of hashes, are then
    compared in full; other rows stay where they are. Only if none of those
    are equal, although more hashes repeat, are all rows compared.
    """
    columns = [quoted(c) for c in df.columns]

    def repeated(rows: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
        return rows.groupBy(*keys).count().filter(F.col("count") > 1)

    def answer(found: bool) -> DataFrame:
        return frame_from_rows(df.sparkSession, [(found,)], "has_duplicates boolean")

    if any(_holds_map(f.dataType) for f in df.schema.fields) or not columns:
        return repeated(df, columns).limit(1).agg((F.count("*") > 0).alias("has_duplicates"))
    hashes = (F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns, F.lit(2)))
    suspects = repeated(df.select(hashes[0].alias("one"), hashes[1].alias("two")), ["one", "two"]).limit(_SUSPECTS)
    listed = [(r["one"], r["two"]) for r in suspects.collect()]
    if not listed:
        return answer(False)
    held = df.filter(hashes[0].isin([one for one, _ in listed]))
    if repeated(held, columns).limit(1).count():
        return answer(True)
    return answer(len(listed) == _SUSPECTS and repeated(df, columns).limit(1).count() > 0)


def _holds_map(kind: T.DataType) -> bool:
    """Maps can neither be hashed nor grouped by."""
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _holds_map(kind.elementType))


def dedup_by_url(pages: DataFrame, url: str = "url", order: str = "page_id") -> DataFrame:
    """One row per URL, the one fetched last; a null URL is a URL of its own.

    A row without an order counts as the earliest. The last fetch is found by
    one aggregate with map-side combine, so a URL with very many copies never
    gathers its rows in one task; rows equal in URL and order merge into one.
    Give it narrow rows: whatever columns there are travel with the winners.
    """
    rest = [c for c in pages.columns if c not in (url, order)]
    # Nulls come first in the order of structs, so any order is later than none.
    last = F.max(F.struct(quoted(order), *[quoted(c) for c in rest])).alias("_last")
    return pages.groupBy(quoted(url)).agg(last).select(url, "_last.*").select(*[quoted(c) for c in pages.columns])


def sort_by_date(df: DataFrame, date: str = "date_added", tiebreak: Sequence[str] = ()) -> DataFrame:
    """Rows by day, rows without one last, then by the tiebreak.

    Rows of a day are spread by a hash of the row, and copies by a random
    number, so that a day with most of the rows is sorted by many tasks.
    """
    hashed = [quoted(f.name) for f in df.schema.fields if not _holds_map(f.dataType)]
    return df.orderBy(F.col(date).asc_nulls_last(), *tiebreak, F.xxhash64(*hashed), F.rand(0))


def sort_desc(df: DataFrame, value: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Largest first: counts, coefficients, importances, flag values."""
    return df.orderBy(F.desc(value), *tiebreak)


def head_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First rows in a stated order (top-k per task, never a full sort)."""
    return df.orderBy(*order).limit(n)


class SchemaMismatch(ValueError):
    """The columns of two frames that should be stacked differ."""


def union_history(history: DataFrame, today: DataFrame) -> DataFrame:
    """History followed by today's rows; the column lists have to agree."""
    if history.columns != today.columns:
        difference = schema_diff(history.columns, today.columns) or "same names in another order"
        raise SchemaMismatch(f"cannot append: {difference}")
    return history.unionByName(today)


def align_to_history(history: DataFrame, today: DataFrame) -> DataFrame:
    """Give today's rows the history's columns: 0 where absent, extras dropped."""
    return reorder_columns(fill_missing_columns(today, history.columns), history.columns)


def union_rows(*parts: DataFrame) -> DataFrame:
    first, *others = parts
    for part in others:
        first = first.unionByName(part)
    return first


def union_store_tiers(stores_by_tier: Mapping[str, DataFrame]) -> DataFrame:
    """One store relation with a tier column from one frame per tier."""
    return union_rows(*[stores.withColumn("tier", F.lit(tier)) for tier, stores in stores_by_tier.items()])
