"""Profiling aggregates. Each is one pass over the table for all columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline import schema as S
from hearthline.functions.text import flag_label
from hearthline.operators.projection import frame_from_rows, quoted
from hearthline.operators.quantiles import clean_number, column_facts, exact_quantiles


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per distinct non-null value."""
    return df.filter(quoted(column).isNotNull()).groupBy(quoted(column).alias("value")).agg(F.count("*").alias("count"))


def flag_distribution(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(flag, value, label, count) for every non-null value a flag takes.

    All flags are counted in one aggregate: each row becomes one entry a flag,
    and entries combine before the shuffle, a row for each value and flag.
    """
    entries = F.array(*[F.struct(F.lit(f).alias("flag"), quoted(f).cast("int").alias("value")) for f in flags])
    counted = df.select(F.inline(entries)).filter(F.col("value").isNotNull()).groupBy("flag", "value").agg(F.count("*").alias("count"))
    return counted.select("flag", "value", flag_label(F.col("value")).alias("label"), "count")


def flag_cardinality(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Number of distinct non-null values per flag, for columns of few values.

    Every task keeps the set of values of each flag and ships one row, so rows
    are neither multiplied by the number of flags nor shuffled. A column of very
    many values belongs in a distinct count of its own.
    """
    row = df.agg(*[F.size(F.collect_set(quoted(f))).cast("long").alias(f"d{i}") for i, f in enumerate(flags)])
    return row.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(f).alias("flag"), F.col(f"d{i}").alias("distinct_values")) for i, f in enumerate(flags)]
            )
        )
    )


def listed_vs_unlisted(df: DataFrame, column: str = "full_address", value: str = S.ADDRESS_MISSING) -> DataFrame:
    """Rows with one value against all other rows."""
    row = df.agg(F.count_if(quoted(column) == value).alias("hit"), F.count("*").alias("all"))
    return row.select(
        F.inline(
            F.array(
                F.struct(F.lit("None Listed").alias("label"), F.col("hit").alias("count")),
                F.struct(F.lit("Listed").alias("label"), (F.col("all") - F.col("hit")).alias("count")),
            )
        )
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls); NaN counts as null in floating columns."""

    def absent(field: T.StructField) -> Column:
        value = quoted(field.name)
        floating = isinstance(field.dataType, T.DoubleType | T.FloatType)
        return value.isNull() | F.isnan(value) if floating else value.isNull()

    fields = df.schema.fields
    row = df.agg(*[F.count_if(absent(f)).alias(f"n{i}") for i, f in enumerate(fields)])
    return row.select(
        F.inline(
            F.array(
                *[F.struct(F.lit(f.name).alias("column"), F.col(f"n{i}").alias("nulls")) for i, f in enumerate(fields)]
            )
        )
    )


_MOMENTS = "column string, count bigint, mean double, std double, min double, max double"


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max per column.

    The scan for the moments also brackets the quartiles; two more settle them.
    """
    columns = list(dict.fromkeys(columns))
    extra = [f(clean_number(c)) for c in columns for f in (F.avg, F.stddev_samp)]
    facts, row = column_facts(df, columns, [0.25, 0.5, 0.75], extra)
    moments = [
        (c, f.count, row[f"x{2 * i}"], row[f"x{2 * i + 1}"], f.low, f.high) for i, (c, f) in enumerate(facts.items())
    ]

    def quartile(fraction: float) -> Column:
        return F.max(F.when(F.col("fraction") == fraction, F.col("value")))

    quartiles = (
        exact_quantiles(df, columns, [0.25, 0.5, 0.75], facts)
        .groupBy("column")
        .agg(quartile(0.25).alias("p25"), quartile(0.5).alias("p50"), quartile(0.75).alias("p75"))
    )
    described = frame_from_rows(df.sparkSession, moments, _MOMENTS).join(quartiles, "column")
    return described.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def target_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(quoted(column)).alias("min"), F.max(quoted(column)).alias("max"))


def standardize_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mean, std) with the population standard deviation."""
    row = df.agg(
        *[F.avg(clean_number(c)).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(clean_number(c)).alias(f"s{i}") for i, c in enumerate(columns)],
    )
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"))
                    for i, c in enumerate(columns)
                ]
            )
        )
    )


# A variance below this share of the second moment is rounding noise.
_CONSTANT = 1e-13
_SUMS = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _pair_correlations(df: DataFrame, columns: Sequence[str], targets: int) -> DataFrame:
    """(i, j, r) for the first ``targets`` columns against each from it on.

    r is Pearson's over rows that have both values, null for a constant side.
    Every task folds its rows into one set of co-moment sums per pair with
    matrix products, so a task ships a few rows however much it read. Many
    pair aggregates in one plan would leave generated code. Values are shifted
    by the column mean first, which keeps the sums well conditioned.
    """
    means = df.agg(*[F.avg(clean_number(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    centres = np.array([0.0 if m is None else m for m in means])

    def co_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = len(centres)
        n, s, t, q, u, p = (np.zeros((targets, k)) for _ in range(6))
        for batch in batches:
            values = batch.to_numpy(dtype=float)
            known = ~np.isnan(values)
            shifted = np.where(known, values - centres, 0.0)
            mask = known.astype(float)
            left, held = shifted[:, :targets], mask[:, :targets]
            n += held.T @ mask
            s += left.T @ mask
            t += held.T @ shifted
            q += (left * left).T @ mask
            u += held.T @ (shifted * shifted)
            p += left.T @ shifted
        i, j = np.triu_indices(targets, 0, k)
        sums = {"n": n, "sx": s, "sy": t, "sxx": q, "syy": u, "sxy": p}
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), **{name: part[i, j] for name, part in sums.items()}})

    numbers = df.select(*[clean_number(c).alias(f"v{i}") for i, c in enumerate(columns)])
    sums = (
        numbers.mapInPandas(co_moments, _SUMS)
        .groupBy("i", "j")
        .agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    )
    c = F.col
    var_x = c("n") * c("sxx") - c("sx") * c("sx")
    var_y = c("n") * c("syy") - c("sy") * c("sy")
    varies = (var_x > _CONSTANT * c("n") * c("sxx")) & (var_y > _CONSTANT * c("n") * c("syy"))
    raw = (c("n") * c("sxy") - c("sx") * c("sy")) / (F.sqrt(var_x) * F.sqrt(var_y))
    return sums.select("i", "j", F.when(varies, F.least(F.greatest(raw, F.lit(-1.0)), F.lit(1.0))).alias("r"))


def _name(columns: Sequence[str], place: str) -> Column:
    return F.get(F.array(*[F.lit(name) for name in columns]), F.col(place))


def correlation_with_target(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """(feature, r) against one column: one row of the correlation matrix."""
    pairs = _pair_correlations(df, [target, *features], 1).filter("j > 0")
    return pairs.select(_name([target, *features], "j").alias("feature"), "r")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) for all ordered pairs; r is null for a constant side."""
    upper = _pair_correlations(df, list(columns), len(columns))
    lower = upper.filter("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "r")
    both = upper.unionByName(lower)
    return both.select(_name(columns, "i").alias("x"), _name(columns, "j").alias("y"), "r")
