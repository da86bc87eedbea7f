"""Projections and operations on the column set."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline import schema as S


def quoted(name: str) -> Column:
    """A column by its exact name; raw listing names hold dots and slashes."""
    return F.col(f"`{name}`")


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns])


def reorder_columns(df: DataFrame, like: Sequence[str]) -> DataFrame:
    """Columns in the order of a target; columns unknown to it are dropped."""
    return project_columns(df, like)


def rename_map(df: DataFrame, names: Mapping[str, str] = S.RENAMES) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def fill_missing_columns(df: DataFrame, columns: Sequence[str], value: Any = 0) -> DataFrame:
    """Add the listed columns that ``df`` lacks, filled with a constant."""
    present = set(df.columns)
    return df.withColumns({c: F.lit(value) for c in columns if c not in present})


def master_schema_project(df: DataFrame, master: Sequence[str] = S.MASTER_COLUMNS, default: Any = 0) -> DataFrame:
    """Exactly the master columns in their order; absent ones get the default."""
    present = set(df.columns)
    return df.select(*[quoted(c) if c in present else F.lit(default).alias(c) for c in master])


def schema_diff(left: Sequence[str], right: Sequence[str]) -> list[tuple[str, str]]:
    """(column, side) for every column that only one side has, by name."""
    only_left = [(c, "left") for c in left if c not in set(right)]
    only_right = [(c, "right") for c in right if c not in set(left)]
    return sorted(only_left + only_right)


def schema_diff_profile(left: DataFrame, right: DataFrame) -> DataFrame:
    """``schema_diff`` with what each unmatched column would lose or need.

    ``filled_rows`` counts the values that a projection onto the other side
    would drop. One aggregate per side, all unmatched columns at once.
    """
    spark = left.sparkSession
    parts = []
    for frame, side in ((left, "left"), (right, "right")):
        names = [c for c, s in schema_diff(left.columns, right.columns) if s == side]
        if names:
            parts.append(non_null_counts(frame, names).withColumn("side", F.lit(side)))
    empty = empty_frame(spark, "column string, filled_rows bigint, side string")
    for part in parts:
        empty = empty.unionByName(part)
    return empty


def non_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("filled_rows")) for i, c in enumerate(columns)]
    return counts.select(F.inline(F.array(*rows)))


def column_types(df: DataFrame) -> DataFrame:
    """(column, type, filled_rows) for every column."""
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    return non_null_counts(df, df.columns).withColumn("type", F.element_at(types, F.col("column")))


def add_ingest_date(df: DataFrame, day: dt.date | None = None) -> DataFrame:
    """Stamp every row with the run's date (today unless given)."""
    return df.withColumn("date_added", F.current_date() if day is None else F.lit(day))


def cast_flags_int(df: DataFrame, flags: Sequence[str] = S.FLAGS) -> DataFrame:
    """Flags to 0/1 integers; a missing flag fails the job instead of passing on."""

    def strict(name: str) -> Column:
        value = quoted(name)
        message = F.concat(F.lit(f"flag {name} is null"))
        return F.when(value.isNull(), F.raise_error(message).cast("int")).otherwise(value.cast("int"))

    return df.withColumns({c: strict(c) for c in flags})


def multi_hot_encode(df: DataFrame, attributes: str, vocabulary: Sequence[str]) -> DataFrame:
    """One 0/1 column per vocabulary entry, for a row's attribute array.

    A projection only: the rows never move.
    """
    held = F.col(attributes)
    return df.withColumns(
        {v: F.coalesce(F.array_contains(held, F.lit(v)), F.lit(False)).cast("int") for v in vocabulary}
    )


def tuple_assign(df: DataFrame, pair: Column, names: Sequence[str]) -> DataFrame:
    """Spread the fields of one struct result over several columns."""
    columns = [F.col("_pair").getField(i) for i in _field_names(df, pair)]
    spread = df.withColumn("_pair", pair).withColumns(dict(zip(names, columns, strict=True)))
    return spread.drop("_pair")


def _field_names(df: DataFrame, pair: Column) -> list[str]:
    kind = df.select(pair.alias("p")).schema["p"].dataType
    if not isinstance(kind, T.StructType):
        raise TypeError("tuple_assign needs a struct column")
    return kind.names


def flag_or(df: DataFrame, inputs: Sequence[str], output: str) -> DataFrame:
    """1 where any input flag is 1; the inputs are dropped."""
    combined = quoted(inputs[0])
    for name in inputs[1:]:
        combined = combined.bitwiseOR(quoted(name))
    return df.withColumn(output, combined).drop(*inputs)


def feature_columns(df: DataFrame, label: str = "price") -> list[str]:
    """Numeric predictors: all columns but the excluded names, text and dates."""
    excluded = set(S.NOT_FEATURES) | {label}
    return [
        f.name
        for f in df.schema.fields
        if f.name not in excluded and isinstance(f.dataType, T.NumericType | T.BooleanType)
    ]


def feature_select(df: DataFrame, label: str = "price", keep: Sequence[str] = ()) -> DataFrame:
    """Features as doubles, the label, and any key columns asked for."""
    names = [c for c in feature_columns(df, label) if c not in keep]
    return df.select(
        *[quoted(k) for k in keep],
        *[quoted(c).cast("double").alias(c) for c in names],
        quoted(label).cast("double").alias(label),
    )


def frame_from_rows(spark: SparkSession, rows: Sequence[tuple], columns: str | T.StructType) -> DataFrame:
    """A small literal frame. Driver rows only: for constants, not for data.

    Handed over as an Arrow table it becomes a local relation, whose size the
    optimizer knows, so a join with it needs no shuffle.
    """
    schema = T.StructType.fromDDL(columns) if isinstance(columns, str) else columns
    arrays = [pa.array([row[i] for row in rows]) for i in range(len(schema.names))]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema)


def empty_frame(spark: SparkSession, columns: str | T.StructType) -> DataFrame:
    """No rows, named and typed columns: the neutral element of a union."""
    return frame_from_rows(spark, [], columns)
