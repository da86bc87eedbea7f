"""Counting listing attributes and folding fee texts into one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline import schema as S
from hearthline.functions.text import is_fee
from hearthline.operators.projection import frame_from_rows


def attribute_rows(df: DataFrame, attributes: str = "attributes", keep: Sequence[str] = ()) -> DataFrame:
    """One row per attribute of a listing.

    The outer form plus a null filter: for the plain form the optimizer tests
    the size of the array first, and so computes an extracted array twice.
    """
    rows = df.select(*keep, F.explode_outer(attributes).alias("attribute"))
    return rows.filter(F.col("attribute").isNotNull())


def attribute_counts(df: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Occurrences of each attribute; repeats within a listing count again."""
    return attribute_rows(df, attributes).groupBy("attribute").agg(F.count("*").alias("count"))


def collapse_fee_group(counts: DataFrame) -> DataFrame:
    """All fee-like attributes under one name, present even when there is none."""
    name = F.when(is_fee(F.col("attribute")), F.lit(S.FEE_ATTRIBUTE)).otherwise(F.col("attribute"))
    folded = counts.select(name.alias("attribute"), "count")
    zero = frame_from_rows(counts.sparkSession, [(S.FEE_ATTRIBUTE, 0)], "attribute string, count bigint")
    return folded.unionByName(zero).groupBy("attribute").agg(F.sum("count").alias("count"))


def min_count_filter(counts: DataFrame, at_least: int = S.MIN_ATTRIBUTE_COUNT) -> DataFrame:
    return counts.filter(F.col("count") >= at_least)


def fee_flag(attributes: Column) -> Column:
    """1 when any attribute of the listing is fee-like."""
    return F.coalesce(F.exists(attributes, is_fee), F.lit(False)).cast("int")


def without_fees(attributes: Column) -> Column:
    return F.filter(attributes, lambda a: ~is_fee(a))


def fee_flag_per_listing(df: DataFrame, attributes: str = "attributes") -> DataFrame:
    """Add ``fee_needed`` and take the fee texts out of the attribute list."""
    held = F.col(attributes)
    return df.withColumns({"fee_needed": fee_flag(held), attributes: without_fees(held)})


def regex_fee_filter(df: DataFrame, attribute: str = "attribute") -> DataFrame:
    return df.filter(is_fee(F.col(attribute)))


def vocab_semi_join(exploded: DataFrame, names: DataFrame, key: str = "attribute") -> DataFrame:
    """Attribute rows that are in the vocabulary.

    Whether the names are broadcast is left to adaptive execution, which knows
    their size; past that it splits the frequent names.
    """
    return exploded.join(names, key, "left_semi")


def vocab_anti_join(exploded: DataFrame, names: DataFrame, key: str = "attribute") -> DataFrame:
    """Attribute rows that are not in the vocabulary."""
    return exploded.join(names, key, "left_anti")


def vocabulary(counts: DataFrame, most: int, at_least: int = S.MIN_ATTRIBUTE_COUNT) -> list[str]:
    """Names of the attributes frequent enough to become columns, most frequent first.

    They have to fit a schema, so the caller says how many columns there may be
    at ``most``; with more the job stops and says so.
    """
    kept = min_count_filter(counts, at_least).orderBy(F.desc("count"), "attribute").limit(most + 1)
    names = [row.attribute for row in kept.select("attribute").collect()]
    if len(names) > most:
        raise ValueError(f"more than {most} attributes would become columns; raise the minimum count")
    return names
